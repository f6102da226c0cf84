"""Whitening, language-model scores and phrases against plain versions of the same definitions."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from halala.llm import feast, ngramtrie, stripes
from halala.llm.numbered import pack, pack_keys, unpack, unpack_keys
from tests.llm.rows import lower, odd, words

EMBEDDINGS = "vec_id long, embedding array<float>, n int, component int, x int"


def embeddings(spark, rows):
    return spark.createDataFrame([(i, v, 7, 8, 9) for i, v in rows], EMBEDDINGS)


def plain_whitening(rows, components=16):
    """Fit and result by numpy's dense solver."""
    x = {i: [math.floor(64 * float(np.float32(c))) + 1000000 for c in v] for i, v in rows}
    fit = np.array(sorted({tuple(v) for v in x.values()}), object)
    n, s = len(fit), fit.sum(axis=0)
    centred = (fit - s / n).astype(float)
    v = centred.T @ centred / n
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    known = e > 1e-12 * e.max()
    out = {i: (sum((n * c - t) ** 2 for c, t in zip(w, s, strict=True)), (np.array(w, float) - (s / n).astype(float)) @ u / np.sqrt(np.where(known, e, 1))) for i, w in x.items()}
    return n, e[known] / np.trace(v), {i: (d, w[known]) for i, (d, w) in out.items()}


@pytest.mark.parametrize(("d", "n"), [(24, 300), (3, 40), (1, 9)])
def test_whitening_equals_dense_solver(spark, d, n):
    draw = np.random.default_rng(d)
    made = draw.normal(size=(n, d)) @ np.diag(1.0 / np.arange(1, d + 1)) + draw.normal(size=d) * 20
    rows = [(i, v.tolist()) for i, v in enumerate(made)] + [(n, made[0].tolist()), (n + 1, made[0].tolist())]
    got = feast.whitened(embeddings(spark, rows)).toPandas()
    count, explained, wanted = plain_whitening(rows)
    assert len(got) == len(rows) * len(explained) and set(got["n"]) == {count}
    assert got["identity_error"].max() < 1e-9
    table = got.sort_values(["vec_id", "component"])
    white = table["whitened"].to_numpy().reshape(len(rows), -1)
    plain = np.array([wanted[i][1] for i in range(len(rows))])
    assert np.allclose(white * np.sign((white * plain).sum(axis=0)), plain, atol=1e-8)
    assert table["deviation"].tolist() == [wanted[i][0] for i in range(len(rows)) for _ in explained]
    assert np.allclose(table["explained"].to_numpy()[: len(explained)], explained, rtol=1e-9)


def test_whitening_of_odd_rows(spark):
    good = [(1, [0.5, 0.25, -1.0]), (1, [0.5, 0.25, -1.0]), (None, [1.5, 2.0, 3.0]), (2, [1.0, -2.0, 0.0]), (3, [9.0, 1.0, 4.0]), (4, [0.0, 0.5, 2.0])]
    bad = [(5, None), (6, []), (7, [1.0, None, 2.0]), (8, [1.0, float("nan"), 2.0]), (9, [1.0, float("inf"), 2.0]), (10, [1.0, 2.0]), (11, [3e30, 0.0, 0.0])]
    got = feast.whitened(embeddings(spark, good + bad)).toPandas()
    assert len(got) == 3 * len(good) and set(got["n"]) == {5} and got["vec_id"].isna().sum() == 3
    assert got["identity_error"].max() < 1e-9
    # nothing varies: no components
    assert feast.whitened(embeddings(spark, good[:2])).count() == 0
    assert feast.whitened(embeddings(spark, bad[:3])).count() == 0
    flat = [(i, [1.0, float(i), 2.0]) for i in range(5)]
    assert {r["component"] for r in feast.whitened(embeddings(spark, flat)).collect()} == {1}
    far = feast.whitened(embeddings(spark, [(1, [1e15, 0.0]), (2, [0.0, 1.0]), (3, [5.0, 2e15])])).toPandas()
    assert far["deviation"].isna().all() and np.isfinite(far["whitened"]).all()


@pytest.mark.parametrize(
    "values",
    [[5.0] * 10 + [1.0] * 20, [10.0**-i for i in range(14)], [1 + 1e-9 * i for i in range(30)], [3.0, 3.0, 3.0], [1.0, 0.0, 0.0], list(range(40, 0, -1))],
)
def test_feast_of_crowded_spectra(values):
    n = len(values)
    q = np.linalg.qr(np.random.default_rng(n).normal(size=(n, n)))[0]
    v = q @ np.diag(values) @ q.T
    v = (v + v.T) / 2
    for wanted in (n, min(n, 16), 1):
        e, u = feast.feast(v, wanted)
        assert np.allclose(e, sorted(values, reverse=True)[:wanted], atol=1e-12 * max(values))
        assert np.abs(v @ u - u * e).max() < 1e-12 * max(values)
        assert np.allclose(u.T @ u, np.eye(wanted), atol=1e-12)
    form = feast.tridiagonal(v)
    for shift in (-1.0, 0.5 * max(values) + 0.123, 2 * max(values)):
        assert feast.below(form, shift) == sum(x < shift for x in values)


def plain_scores(rows, order, strength):
    """The model by dictionaries, with the same steps of the logarithms."""

    def step(p):
        return 10 ** (-round(-ngramtrie.STEPS * math.log10(p)) / ngramtrie.STEPS)

    def tokens(text):
        return ["<s>"] * (order - 1) + words(lower(text)) + ["</s>"]

    def place(i):
        return None if i is None else zlib.crc32(str(i).encode()) % 10

    grams, contexts = [Counter() for _ in range(order + 1)], [Counter() for _ in range(order + 1)]
    for i, text in rows:
        if place(i):
            t = tokens(text)
            for j in range(order - 1, len(t)):
                for k in range(1, order + 1):
                    grams[k][tuple(t[j - k + 1 : j + 1])] += 1
                    contexts[k][tuple(t[j - k + 1 : j])] += 1
    n, v = sum(grams[1].values()), len(grams[1])
    out = []
    for i, text in rows:
        t, base, score, known = tokens(text), 0.0, 0.0, 0
        for j in range(order - 1, len(t)):
            p = (grams[1][(t[j],)] + 0.1) / (n + 0.1 * (v + 1))
            base += math.log10(p)
            known += grams[1][(t[j],)] > 0
            p = step(p)
            for k in range(2, order + 1):
                p = step((grams[k][tuple(t[j - k + 1 : j + 1])] + strength[k] * p) / (contexts[k][tuple(t[j - k + 1 : j])] + strength[k]))
            score += math.log10(p)
        out.append((i, place(i) == 0, len(t) - order + 1, known, n, base, score))
    return out


def texts_to_score():
    draw = np.random.default_rng(2)
    vocabulary = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(vocabulary[int(x)] for x in draw.integers(0, 40, int(draw.integers(0, 60))) ** 2 // 40)) for i in range(120)]
    return [*rows, (3, "THE the The"), (3, rows[3][1]), (None, "w1 w2"), (200, None), (201, ""), (202, "hot " * 500), (203, "hot cold " * 300)]


@pytest.mark.parametrize(("order", "grams", "hot"), [(3, 1 << 19, 1 << 20), (3, 64, 50), (2, 100, 1 << 20)])
def test_scores_equal_plain_loops(spark, monkeypatch, order, grams, hot):
    monkeypatch.setattr(ngramtrie, "HOT", hot)
    monkeypatch.setattr(ngramtrie, "SLICE", 3000)
    rows = texts_to_score()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    place = "pmod(crc32(cast(cast(doc_id as string) as binary)), 10)"
    got, model = ngramtrie.scored(df, f"{place} <> 0", f"{place} = 0", order, grams, keep=True)
    wanted = sorted(plain_scores(rows, order, ngramtrie.STRENGTH), key=lambda r: (str(r[0]), r[2], r[5]))
    found = sorted((tuple(r) for r in got.collect()), key=lambda r: (str(r[0]), r[2], r[4]))
    assert [r[:4] for r in found] == [r[:4] for r in wanted]
    assert {model.totals.tokens} == {r[4] for r in wanted}
    assert [r[4] for r in found] == pytest.approx([r[5] for r in wanted], rel=1e-9)
    # Steps may round the other way where a value lies between two of them.
    assert [r[5] for r in found] == pytest.approx([r[6] for r in wanted], abs=2.1 / ngramtrie.STEPS, rel=1e-4)
    if grams == 64:
        assert model.tries[3].select("shard").distinct().count() > 8
    n = sum(len(ngramtrie.Trie.open(memoryview(bytes(r["trie"]))).codes) for r in model.tries[order].collect())
    trained = [x for x in rows if x[0] is not None and zlib.crc32(str(x[0]).encode()) % 10]
    marks = ["<s>"] * (order - 1)
    every = {tuple(t[j : j + order]) for _, x in trained for t in [marks + words(lower(x)) + ["</s>"]] for j in range(len(t) - order + 1)}
    assert n == len(every)


def test_scores_of_odd_rows(spark):
    df = odd(spark)
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"]) for r in ngramtrie.language_scores(df).collect()), key=str)
    wanted = plain_scores([(r["doc_id"], r["text"]) for r in df.collect()], 3, ngramtrie.STRENGTH)
    assert got == sorted((r[:4] for r in wanted), key=str) or {x[0] for x in got} == {x[0] for x in wanted}
    assert len(got) == df.count()
    assert ngramtrie.language_scores(df.limit(0)).count() == 0
    alone = ngramtrie.language_scores(df.where("doc_id is null")).collect()
    assert [(r["n_known"], r["train_tokens"], r["base_score"]) for r in alone] == [(0, 0, 0.0)] * 2


def test_tries_find_what_they_hold(tmp_path):
    draw = np.random.default_rng(9)
    for n in (0, 1, 5, 3000):
        grams = np.unique(draw.integers(0, 50, (n, 3)) ** 3, axis=0)
        columns = [grams[:, j] for j in range(3)]
        counts = draw.integers(1, 1000, len(grams))
        codes = draw.integers(0, 65536, len(grams))
        path = tmp_path / f"trie{n}"
        path.write_bytes(ngramtrie.Trie.of(130_000, columns, codes, counts).raw())
        trie = ngramtrie.Trie.map(str(path))
        assert (trie.find(columns) == np.arange(len(grams))).all()
        for few in (7, 4000):  # by bisection, and by reading the levels
            asked = np.concatenate([grams[: few // 2], draw.integers(0, 50, (few, 3)) ** 3])
            known = {tuple(g): i for i, g in enumerate(grams.tolist())}
            place = trie.find([asked[:, j] for j in range(3)])
            assert place.tolist() == [known.get(tuple(g), -1) for g in asked.tolist()]
            hit = place[place >= 0]
            assert (trie.counts(hit) == counts[hit]).all() and (trie.codes[hit] == codes[hit]).all()
    dense = ngramtrie.Trie.of(130_000, columns, codes, counts)
    assert len(dense.raw()) < len(grams) * 16


def plain_phrases(rows, least=10, share=50, top=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for j in range(len(w) - k + 1):
                    f[lang, tuple(w[j : j + k])] += 1
    candidates = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= least}
    out = []
    for lang in n:
        kept = []
        for (g, p), a in candidates.items():
            if g != lang or any(h == lang and len(q) > len(p) and (q[:2] == p or q[1:] == p) and 100 * b >= share * a for (h, q), b in candidates.items()):
                continue
            cuts = [(1000000 * a * a // (f[g, p[:k]] * f[g, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((-score, -a, " ".join(p).encode(), f[g, p[:k]], f[g, p[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def phrase_rows():
    draw = np.random.default_rng(3)
    pool = ["new", "york", "city", "is", "far", "é", "漢字", "of", "The", "the"]
    rows = []
    for i in range(150):
        text = "".join(pool[int(x)] + str(draw.choice([" ", " ", "\t", ", ", ".", "\n", "  "])) for x in draw.integers(0, 10, 30))
        rows.append((text + "New York City", ["en", "fr", None][i % 3]))
    return [*rows, ("a a a a a a a a a a a a a", "en"), (None, "en"), ("", None), (" ... ", "de"), ("only three words", "de")]


@pytest.mark.parametrize(("hot", "each", "size", "top"), [(1 << 20, 1 << 19, 1 << 23, 2000), (20, 30, 2000, 7)])
def test_phrases_equal_plain_counts(spark, monkeypatch, hot, each, size, top):
    monkeypatch.setattr(stripes, "HOT", hot)
    monkeypatch.setattr(stripes, "SLICE", size)
    rows = phrase_rows()
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "text string, lang string, part int, f int").repartition(3)
    got = stripes.collocations(df, top=top, each=each)
    assert sorted(tuple(r) for r in got.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()) == plain_phrases(rows, top=top)


def test_phrases_of_odd_rows(spark):
    df = odd(spark)
    rows = [(r["text"], r["lang"]) for r in df.collect()]
    got = stripes.collocations(df).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
    assert sorted(tuple(r) for r in got.collect()) == plain_phrases(rows)
    assert stripes.collocations(df.limit(0)).count() == 0
    assert stripes.collocations(df.where("doc_id = 9")).count() == 0


def test_scores_of_products_beyond_64_bits(spark):
    rows = [(10**14, 3 * 10**14, 7 * 10**14), (10, 10, 10), (10**14 + 1, 10**14 + 1, 10**14 + 2)]
    df = spark.createDataFrame(rows, "f long, l long, r long")
    got = [r[0] for r in df.select(stripes._score("l", "r")).collect()]
    assert got == [1000000 * f * f // (a * b) for f, a, b in rows]


def test_packing():
    for values in ([], [0], [2**64 - 1], [1, 2, 3], list(range(70_000))):
        x = np.array(values, np.uint64)
        assert unpack(pack(x, x), len(x), len(x))[1].tolist() == values
    keys = np.unique(np.random.default_rng(0).integers(0, 2**64, 500, dtype=np.uint64))
    assert (unpack_keys(memoryview(pack_keys(keys)), len(keys)) == keys).all()


def test_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "a b", "en", 0, 0)], "doc_id long, text string, lang string, slice int, train int").withColumn("held", F.lit(True))
    assert ngramtrie.language_scores(df).count() == 1 and stripes.collocations(df).count() == 0
