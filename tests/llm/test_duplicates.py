"""Near-duplicate groups and repeated passages against plain versions."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from halala.llm import debruijn, forest
from halala.llm.components import components
from halala.llm.text import FIRST, SECOND, WHITE, as_texts, slices
from tests.llm.rows import lower, odd, words


def groups(rows, k, least):
    """(doc_id, set size, smallest reachable id, kept) by comparing all pairs; a null id is the largest."""
    sets = []
    for i, text in rows:
        w = words(lower(text))
        sets.append((1 << 70 if i is None else i, {tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()))
    label = [i for i, _ in sets]
    changed = True
    while changed:
        changed = False
        for a, (_, x) in enumerate(sets):
            for b, (_, y) in enumerate(sets):
                if x and y and label[a] > label[b] and 100 * len(x & y) >= least * len(x | y):
                    label[a], changed = label[b], True
    plain = [None if v == 1 << 70 else v for v in label]
    return sorted(((rows[i][0], len(sets[i][1]), plain[i], rows[i][0] == plain[i]) for i in range(len(rows))), key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect()), key=repr)


def near_copies(seed, families, size):
    draw = random.Random(seed)
    rows = []
    for f in range(families):
        base = [f"f{f}w{draw.randrange(60)}" for _ in range(80)]
        for _ in range(draw.randrange(1, size)):
            copy = list(base)
            for _ in range(draw.randrange(0, 6)):
                copy[draw.randrange(len(copy))] = f"e{draw.randrange(40)}"
            rows.append(" ".join(copy))
    draw.shuffle(rows)
    return list(enumerate(rows))


def test_groups_equal_all_pairs(spark):
    rows = near_copies(1, 12, 25)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(forest.near_duplicates(df)) == groups(rows, 3, 85)


def test_groups_in_blocks_and_crowded_regions(spark, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK_ROWS", 7)
    rows = near_copies(2, 2, 90)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(forest.near_duplicates(df)) == groups(rows, 3, 85)


def test_groups_of_odd_rows(spark):
    df = odd(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert found(forest.near_duplicates(df)) == groups(rows, 3, 85)
    assert found(forest.near_duplicates(df.limit(0))) == []


def test_neighbours_are_chained_over_batches():
    """A run longer than DENSE keeps a chain at full depth; a batch border changes nothing."""
    labels = np.zeros((20, forest.DEPTH), np.uint32)
    labels[10:, 5] = 1
    def batch(a, b):
        return pa.RecordBatch.from_arrays(
            [pa.array([0] * (b - a), pa.int32()), pa.array([x.tobytes() for x in labels[a:b]]), pa.array(range(a, b), pa.int64())], names=["tree", "label", "id"]
        )
    def edges(*batches):
        return [e for out in forest._neighbours(iter(batches)) for e in zip(out.column("a").to_pylist(), out.column("b").to_pylist(), strict=True)]
    whole = edges(batch(0, 20))
    assert whole == [(i, i + 1) for i in range(19)]
    assert edges(batch(0, 7), batch(7, 12), batch(12, 20)) == whole


def joined_by(edges, n):
    label = list(range(n))
    def top(x):
        while label[x] != x:
            x = label[x]
        return x
    for a, b in edges:
        label[top(a)] = top(b)
    return len({top(x) for x in range(n)})


def test_long_runs_stay_whole():
    """All rows that share the first values are chained, though their labels differ below."""
    n = 6000
    labels = np.sort(np.random.default_rng(1).integers(0, 2**32, n, dtype=np.uint32))[:, None] * np.ones(forest.DEPTH, np.uint32)
    labels[:, : forest.BASE] = 7
    columns = [pa.array([0] * n, pa.int32()), pa.array([x.tobytes() for x in labels]), pa.array(range(n), pa.int64())]
    batch = pa.RecordBatch.from_arrays(columns, names=["tree", "label", "id"])
    edges = [e for out in forest._neighbours(iter([batch])) for e in zip(out.column("a").to_pylist(), out.column("b").to_pylist(), strict=True)]
    assert joined_by(edges, n) == 1


def test_runs_over_partitions_stay_whole(spark):
    """Rows that meet in one tree only, whose order is cut into partitions."""
    draw, n = np.random.default_rng(2), 400
    values = draw.integers(0, 2**32, (n, forest.TREES, forest.DEPTH), dtype=np.uint32)
    values[:, 10, : forest.BASE] = 7
    rows = [(int(i), int(i), int(i), bytearray(v.tobytes())) for i, v in enumerate(values)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "60")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        edges = [tuple(e) for e in forest.candidate_edges(spark.createDataFrame(rows, "d1 long, d2 long, node long, signature binary")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert joined_by(edges, n) == 1


def test_estimates_follow_similarity():
    """Signature values agree about as often as sets overlap."""
    texts = as_texts(pa.array([" ".join(f"a{i}" for i in range(s, s + 300)) for s in (0, 30, 150)]))
    values, first = forest.shingle_sets(texts, 3)
    sets = [set(values[a:b].tolist()) for a, b in zip(first, first[1:], strict=False)]
    for other in (1, 2):
        true = len(sets[0] & sets[other]) / len(sets[0] | sets[other])
        hits = 0
        for mask, odd_ in zip(forest._MASKS, forest._ODD, strict=True):
            least = [int(((np.array(list(s), np.uint64) ^ mask) * odd_).min()) for s in (sets[0], sets[other])]
            hits += least[0] == least[1]
        assert abs(hits / len(forest._MASKS) - true) < 0.15


def test_components(spark):
    draw = random.Random(5)
    edges = [(i, i + 1) for i in range(0, 60) if i % 20 != 19] + [(100, x) for x in range(101, 140)] + [(500, 500), (None, 7)]
    edges += [(draw.randrange(1000, 1060), draw.randrange(1000, 1060)) for _ in range(40)]
    label = {x: x for e in edges if None not in e and e[0] != e[1] for x in e}
    for _ in range(70):
        for a, b in edges:
            if a in label and b in label and a != b:
                label[a] = label[b] = min(label[a], label[b])
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["component"] for r in got.collect()} == label
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def kept(rows, window):
    """(doc_id, words, removed, digest) by looking at every window of every document."""
    first = {}
    for i, text in rows:
        i = 1 << 70 if i is None else i
        w = words(text)
        for j in range(len(w) - window + 1):
            key = tuple(w[j : j + window])
            first[key] = min(first.get(key, 1 << 71), i)
    out = []
    for i, text in rows:
        w = words(text)
        gone = set()
        for j in range(len(w) - window + 1):
            if first[tuple(w[j : j + window])] < (1 << 70 if i is None else i):
                gone.update(range(j, j + window))
        left = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out, key=repr)


def removed(df, window, k):
    got = debruijn.without_repeats(df, window, k).select("doc_id", "n_words", "n_removed", "kept_sha256")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_repeats_equal_plain_version(spark):
    draw = random.Random(3)
    rows = []
    for i in range(120):  # few different words: many windows repeat, also within a document
        parts = [draw.choice("ab") if draw.random() < 0.7 else f"u{draw.randrange(400)}" for _ in range(draw.randrange(0, 60))]
        if rows and draw.random() < 0.5:
            other = words(draw.choice(rows)[1])
            at = draw.randrange(len(other) + 1)
            parts += other[at : at + draw.randrange(30)]
        rows.append((i, " ".join(parts)))
    rows += [(5, rows[5][1]), (5, "other text with this number"), (None, rows[9][1])]
    draw.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for window, k in ((5, 2), (12, 6)):
        assert removed(df, window, k) == kept(rows, window)


def test_repeats_in_periodic_texts(spark):
    """Earlier copies with fewer windows than the period, also of other words and in the middle of a text."""
    rows, window = [], 12
    for period in range(1, 7):
        for size in range(window, window + period):
            for turn in range(period):
                name = f"p{period}s{size}t{turn}"
                cycle = [f"{name}w{j}" for j in range(period)]
                rows.append((len(rows), " ".join(cycle[(turn + j) % period] for j in range(size))))
                whole = [cycle[j % period] for j in range(4 * window + size)]
                rows.append((len(rows), " ".join(whole)))
                rows.append((len(rows), " ".join([f"{name}x", *whole[1:], f"{name}y"])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for k in (2, 6):
        assert removed(df, window, k) == kept(rows, window)


def test_rows_under_one_id_keep_their_own_repeats(spark):
    """Two texts without an id whose 32-bit hashes are equal: only the one with the passage loses it."""
    passage = " ".join(f"p{i}" for i in range(60))
    made = spark.range(300_000).select(F.concat_ws(" ", *(F.concat(F.lit(f"r{i}x"), "id") for i in range(70))).alias("text"))
    held = made.select(F.concat(F.lit(passage + " "), "text").alias("text"))
    both = held.join(made.withColumnRenamed("text", "other"), F.hash(held["text"]) == F.hash(F.col("other"))).limit(1).collect()
    assert both, "no such pair among these texts"
    rows = [(1, passage), (None, both[0]["text"]), (None, both[0]["other"])]
    assert removed(spark.createDataFrame(rows, "doc_id long, text string"), 50, 6) == kept(rows, 50)


def test_repeats_of_odd_rows(spark):
    df = odd(spark)
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    assert removed(df, 50, 6) == kept(rows, 50)
    assert removed(df.limit(0), 50, 6) == []


def test_hashes_of_structured_runs():
    for n in (64, 512, 2048):
        one = np.array([bin(i).count("1") % 2 for i in range(n)], np.uint8)
        data = np.concatenate([one, 1 - one])
        for by in (FIRST, SECOND):
            for hashed in (by.bytes(data, np.array([0, n]), np.array([n, 2 * n])), by.runs(data.astype(np.uint64), np.array([0, n]), np.array([n, 2 * n]))):
                assert hashed[0] != hashed[1]
    draw = np.random.default_rng(3).integers(0, 3, 120).astype(np.uint64)
    starts, ends = np.triu_indices(120)
    known = {}
    for a, b, h in zip(starts, ends + 1, FIRST.runs(draw, starts, ends + 1).tolist(), strict=True):
        assert known.setdefault(tuple(draw[a:b]), h) == h
    assert len(set(known.values())) == len(known)


def test_words_and_hashes():
    values = ["a  b\tc", "", None, " x", "y ", "a b", "ß é"]
    read = as_texts(pa.array(values, pa.string()))
    found_words = read.words(~WHITE)
    raw = read.data.tobytes()
    got = [[raw[a:b].decode() for a, b in list(zip(found_words.starts, found_words.ends, strict=True))[x:y]] for x, y in zip(found_words.first, found_words.first[1:], strict=False)]
    assert got == [words(v) for v in values]
    for by in (FIRST, SECOND):
        hashes = dict(zip(sum(got, []), found_words.hashes(by).tolist(), strict=True))
        assert len(set(hashes.values())) == len(hashes)
        shifted = as_texts(pa.array(["zz " + " ".join(hashes)])).words(~WHITE)
        assert shifted.hashes(by).tolist()[1:] == list(hashes.values())
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * n for n in (10, 500, 10, 10)])], names=["text"])
    assert [p.num_rows for p in slices([batch], limit=300)] != [4]
    assert sum(p.num_rows for p in slices([batch], limit=300)) == 4


def test_windows_are_taken_apart_only_around_a_common_half(spark, monkeypatch):
    """A common run shorter than half a window is no reason to compare windows; a common half is, on its own side only."""

    def text(name, n, common):
        return " ".join([f"{name}{i}" for i in range(n)] + common + [f"{name}{i}" for i in range(n, 2 * n)])

    def windows_of(rows, window, k):
        tables = []

        def kept_table(df, write=debruijn.written):
            tables.append(write(df))
            return tables[-1]

        monkeypatch.setattr(debruijn, "written", kept_table)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert removed(df, window, k) == kept(rows, window)
        monkeypatch.undo()
        return next(t for t in tables if "w1" in t.columns).select("whole", "at").distinct().count()

    # Only the two words of the minimizer are the same.
    short = [(i, text(f"d{i}x", 40, ["same", "words"])) for i in range(40)]
    assert windows_of(short, 20, 2) == 0
    long = [(i, text(f"d{i}x", 40, [f"c{j}" for j in range(60)])) for i in range(3)]
    fragments = debruijn._key(spark.createDataFrame(long, "doc_id long, text string")).mapInArrow(debruijn._fragments(20, 2), debruijn.FRAGMENTS)
    assert 0 < windows_of(long, 20, 2) < fragments.agg({"n": "sum"}).first()[0]
