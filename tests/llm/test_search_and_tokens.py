"""Decontamination and token files against plain versions."""

from __future__ import annotations

import hashlib
import random
import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest

from halala.llm import eliasfano, wumanber
from halala.llm.fitting import of_each_class
from halala.llm.queries import tokenizer_file
from halala.llm.shared import BATCH_SETTING, over_texts
from halala.session import scratch_path
from tests.llm.rows import lower, odd

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def judged(docs, items, span):
    windows = {}
    for item, text in items:
        w = WORD.findall(lower(text))
        n = min(span, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(item)
    sizes = {len(k) for k in windows}
    out = []
    for i, text in docs:
        w = WORD.findall(lower(text))
        hit, named = set(), set()
        for n in sizes:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in windows:
                    hit.update(range(j, j + n))
                    named |= windows[tuple(w[j : j + n])]
        names = sorted(str(x) for x in named if x is not None)
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize(("span", "block"), [(10, 200_000), (4, 60), (2, 200_000)])
def test_search_equals_plain_version(spark, span, block):
    draw = random.Random(span)
    vocabulary = [f"t{i}" for i in range(6)] + ["É", "ab", "a"]
    items = [(i, " ".join(draw.choice(vocabulary) for _ in range(draw.randrange(0, 14)))) for i in range(25)]
    items += [(3, items[4][1]), (None, "t1 t2 t3 t4 t5 t0 ab a t1 t2 t3"), (40, None), (41, "")]
    docs = []
    for i in range(60):
        text = " ".join(draw.choice(vocabulary) + draw.choice(["", ".", ", -", "\n"]) for _ in range(draw.randrange(0, 80)))
        if i % 3 == 0:
            text += " " + draw.choice(items[:25])[1].upper() + " tail"
        docs.append((i, text))
    docs += [(1, docs[1][1]), (1, None), (None, docs[3][1])]
    got = wumanber.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), span, block)
    assert found(got) == judged(docs, items, span)


def test_search_of_odd_rows(spark):
    df = odd(spark)
    docs = [(r["doc_id"], r["text"]) for r in df.collect()]
    items = [(1, "jumps over the lazy dog and runs far away from here"), (2, "one")]
    benchmark = spark.createDataFrame([(*i, 7) for i in items], "item_id long, text string, doc_id long")
    assert found(wumanber.contamination(df, benchmark)) == judged(docs, items, 10)
    assert found(wumanber.contamination(df, benchmark.limit(0))) == judged(docs, [], 10)
    assert found(wumanber.contamination(df.limit(0), benchmark)) == []


@pytest.mark.parametrize("values", [[], [0], [5], [0, 0, 0], [1, 1, 2, 3, 500, 500, 10**9], list(range(0, 5000, 3)), [0] * 700 + [10**6] * 700])
def test_elias_fano_round_trip(values):
    coded = eliasfano.EliasFano.of(np.array(values, np.int64))
    assert coded.all().tolist() == values
    for i in range(0, len(values), max(1, len(values) // 50)):
        assert coded.select(i) == values[i]
    with pytest.raises(IndexError):
        coded.select(len(values))
    if len(values) > 1000:
        assert len(coded.low) + len(coded.high) <= len(values) * (3 + coded.low_bits) // 8 + 2


TEXTS = ["a  b", "a   b \n c", " lead", "trail ", "don't stop", "x\u00a0 y", "漢 字 　 z", "é à è", "1 2  3", "", " ", "  ", "a\n b", "\t a b", "<|endoftext|> a", "a<|endoftext|>b", "x <|endoftext|><|endoftext|>  y", "<|endoftext", "|>", "🙂 🙂"]


def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_file())


def test_encoder_equals_library():
    draw = random.Random(8)
    pool = ["word", "é", "\u3000", "\u00a0", " ", "  ", "\n", "x1", "!", "'s", "漢", "\u2028", "\x1c", "ß", "\x85", "'", ",", ".", "×", "\r\n", "\t", "ll", "«", "“", "a\u0301", "\x00"]
    texts = TEXTS + ["".join(draw.choice(pool) + draw.choice(["", " "]) for _ in range(30)) for _ in range(1500)]
    own, sizes = eliasfano.Encoder(tokenizer_file()).encode(pa.array(texts))
    wanted = [x.ids for x in library().encode_batch(texts, add_special_tokens=False)]
    assert sizes.tolist() == [len(x) for x in wanted]
    assert own.tolist() == sum(wanted, [])


def mirrored(n):
    """A text over two letters that hides from linear hashes, and its mirror."""
    one = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
    return one, one.translate(str.maketrans("ab", "ba"))


def test_structured_pieces_keep_their_own_ids():
    texts = [t for n in (64, 512, 1024, 2048) for t in mirrored(n)]
    own, sizes = eliasfano.Encoder(tokenizer_file()).encode(pa.array(texts))
    wanted = [library().encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in np.split(own, np.cumsum(sizes)[:-1])] == wanted


def test_pieces_with_one_hash_are_encoded_apart(monkeypatch):
    monkeypatch.setattr(eliasfano, "FIRST", type("Same", (), {"bytes": lambda self, data, a, b: np.zeros(len(a), np.uint64)})())
    encoder = eliasfano.Encoder(tokenizer_file())
    for texts in (["one"], ["two"], ["one two", "three"]):
        own, _ = encoder.encode(pa.array(texts))
        assert own.tolist() == sum((library().encode(t, add_special_tokens=False).ids for t in texts), [])


@pytest.mark.parametrize("n", [1, 63, 64, 65, 5000])
@pytest.mark.parametrize("top", [1, 3, 5000, 2**40, 2**62])
def test_places_of_a_sequence(n, top):
    draw = np.random.default_rng(n)
    values = np.sort(draw.integers(0, top, n))
    coded = eliasfano.EliasFano.of(values)
    some = draw.integers(0, n, 100)
    assert (coded.select(some) == values[some]).all()
    for wanted in (draw.integers(0, top, 3), values[some]):
        assert (coded.successor(wanted) == np.searchsorted(values, wanted)).all()
        begin = draw.integers(0, n, len(wanted))
        end = np.minimum(n, begin + draw.integers(0, 9, len(wanted)))
        inside = np.clip(np.searchsorted(values, wanted), begin, end)
        assert (coded.successor(wanted, begin, end) == inside).all()


def expected(rows):
    made, out, start = library(), [], 0
    for i, text in rows:
        ids = made.encode(text or "", add_special_tokens=False).ids + [0]
        out.append((i, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        start += len(ids)
    return out


def test_token_files_equal_library(spark):
    rows = [(3 * i - 20, t) for i, t in enumerate(TEXTS)] + [(100, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = eliasfano.encoded(df, tokenizer_file(), block_ids=8)
    assert sorted(tuple(r) for r in got.collect()) == expected(rows)


def test_token_files_of_odd_rows(spark):
    df = odd(spark)
    path = scratch_path(spark)
    eliasfano.write_tokens(df, path, tokenizer_file())
    got = [tuple(r) for r in eliasfano.read_documents(spark, path).orderBy("start").collect()]
    assert [r[0] for r in got] == [1, 2, 2, 2, 3, 4, 5, 6, 7, 8, 9, 10, None, None]
    assert [r[1] for r in got] == np.cumsum([0] + [r[2] for r in got])[:-1].tolist()
    wanted = {(i, n, c) for i, _, n, c in expected([(r["doc_id"], r["text"]) for r in df.collect()])}
    assert {(r[0], r[2], r[3]) for r in got} == wanted
    assert eliasfano.encoded(df.limit(0), tokenizer_file()).collect() == []


def test_ids_of_long_pieces_are_not_kept_without_end(monkeypatch):
    monkeypatch.setattr(eliasfano.Encoder, "KEPT_IDS", 2000, raising=False)
    encoder = eliasfano.Encoder(tokenizer_file())
    draw = random.Random(3)
    for _ in range(12):
        text = "".join(draw.choice("漢字語文一二三") for _ in range(500))
        own, _ = encoder.encode(pa.array([text]))
        assert own.tolist() == library().encode(text, add_special_tokens=False).ids
        assert len(encoder.flat) <= 2000 + len(own)


def test_texts_come_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], names=["n", "size"])

    texts = spark.range(0, 4000, 1, 1).selectExpr("id", "repeat('x', 3000) as text")
    before = spark.conf.get(BATCH_SETTING, None)
    try:
        spark.conf.unset(BATCH_SETTING)
        got = over_texts(texts, sizes, "n long, size long").collect()
        assert sum(r["n"] for r in got) == 4000
        assert max(r["size"] for r in got) < 5_000_000
        spark.conf.set(BATCH_SETTING, "64m")
        assert len(over_texts(texts, sizes, "n long, size long").collect()) == 1
    finally:
        spark.conf.unset(BATCH_SETTING)
        if before is not None:
            spark.conf.set(BATCH_SETTING, before)


def test_small_tables_of_the_driver_need_no_python_workers(spark, capsys):
    """Rows of Python objects are read by workers of a second kind, which stay beside those of the texts."""
    path = scratch_path(spark)
    eliasfano.write_tokens(odd(spark), path, tokenizer_file())
    eliasfano.open_tokens(spark, path).explain()
    rows = spark.range(40).selectExpr("id", "if(id % 4 = 0, 'a', 'b') as name")
    few = of_each_class(rows, "name", ["id"], 20, 40)
    few.explain()
    assert "ExistingRDD" not in capsys.readouterr().out
    assert sum(r["name"] == "a" for r in few.collect()) == 10
    assert of_each_class(rows.limit(0), "name", ["id"], 20, 40).collect() == []
