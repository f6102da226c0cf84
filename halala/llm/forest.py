"""Near-duplicates by an LSH forest over MinHash signatures, every link confirmed on full shingle sets.

A tree sorts all distinct sets by a label of `DEPTH` signature values. Neighbours in that order whose
labels agree on the first `BASE` values are candidates, however many rows a region has. Candidates of
all trees form clusters; within a cluster every pair of full sets is compared,
in blocks of bounded size, so no signature decides a link and no partner is capped.

A pair of sets with Jaccard similarity 0.85 is neighboured in a tree with a chance of 0.85**4 = 0.52,
and misses all 20 trees with a chance below 1e-6. Equal sets always meet.

Edge cases: null texts and texts without words have no set and link with nothing; fewer words than a
shingle make one shingle of the whole sequence. Repeated rows and repeated ids are documents of their
own: equal sets are collapsed before anything is compared, so a third of all rows may be copies. Null
ids count as the largest id and are returned as null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halala.llm.components import components
from halala.llm.shared import over_texts, written
from halala.llm.text import FIRST, SECOND, WHITE, Texts, as_texts, mix, run_starts, signed, slices

TREES, DEPTH, BASE = 20, 8, 4
BLOCK_SHINGLES, BLOCK_ROWS = 1 << 19, 1024  # aim for one block of a cluster
NO_ID = (1 << 63) - 1

SETS = "id bigint, rank bigint, n_shingles bigint, d1 bigint, d2 bigint, signature binary"
LABELS = "tree int, label binary, d1 bigint, d2 bigint, id bigint"
EDGES = "a bigint, b bigint"
BORDERED = "a bigint, b bigint, tree int, prefix binary"

_DRAW = np.random.default_rng(404)
_MASKS = _DRAW.integers(0, 2**64, TREES * DEPTH, dtype=np.uint64)
_ODD = _DRAW.integers(0, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(texts: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every row, sorted within rows, and the first of each row."""
    words = texts.words(~WHITE)
    hashes, counts = words.hashes(), words.counts()
    starts = run_starts(words, k)
    short = np.flatnonzero((counts > 0) & (counts < k))
    begin = np.concatenate([starts, words.first[short]])
    end = np.concatenate([starts + k, words.first[short + 1]])
    values = FIRST.runs(hashes, begin, end)
    rows = np.concatenate([words.rows()[starts], short])
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[new], rows[new]
    return values, np.searchsorted(rows, np.arange(len(texts) + 1))


def _signatures(k: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            values, first = shingle_sets(as_texts(piece.column("text"), lower=True), k)
            sizes = np.diff(first)
            full = np.flatnonzero(sizes)
            signature = np.zeros((len(sizes), TREES * DEPTH), ">u4")
            digests = np.zeros((2, len(sizes)), np.int64)
            if len(full):
                at = first[:-1][full]
                for i, (mask, odd) in enumerate(zip(_MASKS, _ODD, strict=True)):
                    least = np.minimum.reduceat((values ^ mask) * odd, at)
                    signature[full, i] = (mix(least) >> np.uint64(32)).astype(np.uint32)
                for i, of_set in enumerate((FIRST, SECOND)):
                    digests[i, full] = signed(of_set.runs(values, at, first[1:][full]))
            raw = [row.tobytes() for row in signature]
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), piece.column("rank"), pa.array(sizes.astype(np.int64)), pa.array(digests[0]), pa.array(digests[1]), pa.array(raw, pa.binary())],
                names=["id", "rank", "n_shingles", "d1", "d2", "signature"],
            )

    return of_batches


def _labels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    width = 4 * DEPTH
    for batch in batches:
        for a in range(0, batch.num_rows, 4096):
            part = batch.slice(a, 4096)
            n = part.num_rows
            raw = np.frombuffer(b"".join(part.column("signature").to_pylist()), np.uint8).reshape(n, TREES, width)
            label = pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n * TREES, [None, pa.py_buffer(raw.tobytes())])
            again = [pa.array(np.repeat(part.column(c).to_numpy(), TREES)) for c in ("d1", "d2", "id")]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.tile(np.arange(TREES, dtype=np.int32), n)), label.cast(pa.binary()), *again],
                names=["tree", "label", "d1", "d2", "id"],
            )


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate edges of sorted labels; one row of the order before is carried over batches.

    Every row links to the one before it when their labels agree on BASE values, so a run is chained
    whatever its length.
    """
    last, last_tree, last_id = np.zeros(DEPTH, np.uint32), -1, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        labels = np.frombuffer(b"".join(batch.column("label").to_pylist()), np.uint32).reshape(n, DEPTH)
        trees, ids = batch.column("tree").to_numpy(), batch.column("id").to_numpy()
        before = np.vstack([last[None], labels[:-1]])
        same = (before[:, :BASE] == labels[:, :BASE]).all(axis=1) & (np.concatenate([[last_tree], trees[:-1]]) == trees)
        at = np.flatnonzero(same)
        left = np.concatenate([[last_id], ids[:-1]])
        yield pa.RecordBatch.from_arrays([pa.array(left[at]), pa.array(ids[at])], names=["a", "b"])
        last, last_tree, last_id = labels[-1].copy(), trees[-1], ids[-1]


def _with_borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Candidate edges, and the first and last row of the partition by tree and prefix, as edges to itself."""
    ends: list[pa.RecordBatch] = []

    def watched() -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                ends[len(ends) and 1 :] = [batch.slice(0, 1)] * (not ends) + [batch.slice(batch.num_rows - 1, 1)]
                yield batch

    for edges in _neighbours(watched()):
        nothing = [pa.nulls(edges.num_rows, kind) for kind in (pa.int32(), pa.binary())]
        yield pa.RecordBatch.from_arrays([*edges.columns, *nothing], names=["a", "b", "tree", "prefix"])
    for row in ends:
        prefix = pa.array([row.column("label")[0].as_py()[: 4 * BASE]], pa.binary())
        yield pa.RecordBatch.from_arrays([row.column("id"), row.column("id"), row.column("tree"), prefix], names=["a", "b", "tree", "prefix"])


def _links(sets: list[np.ndarray], least: int) -> Iterator[tuple[int, int]]:
    """A spanning forest of the pairs of sets with 100 * |both| >= least * |either|."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    values, owner = np.concatenate(sets), np.repeat(np.arange(n), sizes)
    _, number, times = np.unique(values, return_inverse=True, return_counts=True)
    held = times[number] > 1
    owner, number = owner[held], np.unique(number[held], return_inverse=True)[1]
    common = np.zeros((n, n), np.float32)  # counts below 2**24 are exact
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    width = max(64, (1 << 21) // n)
    cuts = np.searchsorted(number, np.arange(0, (int(number[-1]) if len(number) else -1) + 1 + width, width))
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        if a < b:
            part = np.zeros((n, width), np.float32)
            part[owner[a:b], number[a:b] - i * width] = 1
            common += part @ part.T
    both = common.astype(np.int64)
    linked = 100 * both >= least * (sizes[:, None] + sizes[None, :] - both)
    unseen = np.ones(n, bool)
    for root in range(n):
        if not unseen[root]:
            continue
        unseen[root] = False
        front = [root]
        while front:
            at = front.pop()
            found = np.flatnonzero(linked[at] & unseen)
            unseen[found] = False
            front += found.tolist()
            yield from ((root, int(x)) for x in found)


def _confirm(k: int, least: int):
    def of_group(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates("id").sort_values("id", ignore_index=True)
        values, first = shingle_sets(as_texts(pa.array(rows["text"], pa.string()), lower=True), k)
        sets = [values[a:b] for a, b in zip(first, first[1:], strict=False)]
        ids = rows["id"].to_numpy()
        return pd.DataFrame([(ids[a], ids[b]) for a, b in _links(sets, least)], columns=["a", "b"])

    return of_group


def _distinct_sets(sets: DataFrame) -> DataFrame:
    """One row per distinct set: the first row that has it, by (id, rank), and its signature."""
    held = sets.where("n_shingles > 0").groupBy("n_shingles", "d1", "d2")
    return held.agg(F.min(F.struct("id", "rank")).alias("own"), F.max("signature").alias("signature")).select("n_shingles", "d1", "d2", "own.*", "signature")


def candidate_edges(distinct: DataFrame) -> DataFrame:
    """Edges (a, b) between row numbers of sets that are neighbours in at least one tree."""
    order = ["tree", "label", "d1", "d2"]
    labels = distinct.select("d1", "d2", "node", "signature").withColumnRenamed("node", "id").mapInArrow(_labels, LABELS)
    found = written(labels.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_with_borders, BORDERED))
    # A run that goes over partitions has the first or last row of each of them.
    borders = found.where("tree is not null").select("tree", "prefix", F.col("b").alias("id"))
    over = borders.join(borders.groupBy("tree", "prefix").agg(F.min("id").alias("a")), ["tree", "prefix"]).where("a <> id")
    return found.where("tree is null").select("a", "b").union(over.select("a", F.col("id").alias("b"))).distinct()


def node_of() -> Column:
    """Number of a set: its digest, folded; distinct sets meet with a chance of 2**-64 a pair."""
    return F.xxhash64("n_shingles", "d1", "d2")


def near_duplicates(docs: DataFrame, k: int = 3, least: int = 85) -> DataFrame:
    """(doc_id, rank, n_shingles, component_id, kept, first) for every row of docs(doc_id, text, …).

    Two sets are linked when 100 * |both| >= least * |either|; component_id is the smallest doc_id
    reached over links. `rank` is a hash of the text; `first` marks the row of each component with the
    smallest (doc_id, rank), and its exact repetitions, and all rows without words.
    """
    ids = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID))
    sets = written(over_texts(docs.select(ids.alias("id"), F.xxhash64("text").alias("rank"), "text"), _signatures(k), SETS))
    distinct = _distinct_sets(sets).withColumn("node", node_of())
    clusters = components(candidate_edges(distinct)).withColumnRenamed("component", "cluster")

    members = written(distinct.select("node", "n_shingles", "d1", "d2", "id", "rank").join(clusters, "node"))
    sizes = members.groupBy("cluster").agg(F.sum("n_shingles").alias("shingles"), F.count("*").alias("rows"))
    parts = F.ceil(F.greatest(F.col("shingles") / BLOCK_SHINGLES, F.col("rows") / BLOCK_ROWS)).cast("int")
    blocks = members.join(sizes.select("cluster", parts.alias("parts")), "cluster")
    block = F.pmod("node", "parts").cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda x: F.struct(F.least(x, "block").alias("low"), F.greatest(x, "block").alias("high")))
    placed = (
        blocks.withColumn("block", block)
        .select("node", "id", "n_shingles", "cluster", F.explode(others).alias("pair"))
        .select("node", "id", "n_shingles", "cluster", "pair.low", "pair.high")
    )
    texts = docs.select(ids.alias("id"), "text").where("text is not null")
    # Joined by sorting at every size: what is shuffled then grows in proportion to the texts.
    wanted = members.select("id").distinct().hint("merge")
    # A repeated id may have other texts: only the text whose set is meant is compared.
    sized = over_texts(texts.join(wanted, "id", "left_semi"), _sized(k), "id bigint, d1 bigint, d2 bigint, text string")
    of_node = members.select("node", "id", "d1", "d2")
    picked = sized.join(of_node, ["id", "d1", "d2"]).groupBy("node").agg(F.min("text").alias("text"))
    pairs = placed.select("node", "cluster", "low", "high").join(picked, "node").withColumnRenamed("node", "id")
    confirmed = pairs.groupBy("cluster", "low", "high").applyInPandas(_confirm(k, least), EDGES)
    linked = components(written(confirmed.distinct()))

    first = F.struct("id", "rank")
    least_row = members.select("node", "id", "rank").join(linked, "node").groupBy("component").agg(F.min(first).alias("least_row"))
    of_set = linked.join(least_row, "component").select("node", "least_row")
    found = sets.select("id", "rank", "n_shingles", F.when(F.col("n_shingles") > 0, node_of()).alias("node"))
    own = distinct.select("node", first.alias("own"))
    named = own.join(of_set, "node", "left").select("node", F.coalesce("least_row", "own").alias("least_row"))
    # Written first: a set that a third of all rows has is then split over tasks by the plain join.
    joined = found.join(written(named), "node", "left").withColumn("component_id", F.coalesce("least_row.id", "id"))
    real = [F.when(F.col(c) != NO_ID, F.col(c)).alias(n) for c, n in (("id", "doc_id"), ("component_id", "component_id"))]
    is_first = F.coalesce(F.col("least_row") == first, F.lit(True)).alias("first")
    return joined.select(real[0], "rank", "n_shingles", real[1], (F.col("id") == F.col("component_id")).alias("kept"), is_first)


def _sized(k: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            values, first = shingle_sets(as_texts(piece.column("text"), lower=True), k)
            full = np.flatnonzero(np.diff(first))
            at, to = first[:-1][full], first[1:][full]
            kept = piece.take(pa.array(full))
            digests = [pa.array(signed(by.runs(values, at, to))) for by in (FIRST, SECOND)]
            yield pa.RecordBatch.from_arrays([kept.column("id"), *digests, kept.column("text")], names=["id", "d1", "d2", "text"])

    return of_batches
