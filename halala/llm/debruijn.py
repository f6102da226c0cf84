"""Removal of long repeated passages, over the de Bruijn graph of all windows of `window` words.

Windows are the edges of the graph. Consecutive windows of a text that share their minimizer (the
k-word run of least hash) form a fragment, a piece of path that needs one row. Equal windows have
equal minimizers, so a minimizer that stays in one document cannot hold a repeated window. Joins then

* keep the fragments whose minimizer occurs in two documents,
* find each fragment's first document, and whether its predecessor and successor are the same in
  every occurrence (such fragments are glued into nonbranching paths),
* take windows apart only where different fragments agree around one minimizer, from the source
  coordinates (document, first word) of one occurrence of each: a window has at least half of its
  other words to the left or to the right of its minimizer, so fragments with a common window agree in
  that half, and only the windows over it are wanted. And they
* hand each document its paths as spans of words.

Fragments are identified by two 64-bit hashes, of their minimizer and of all their words.

Edge cases: null or blank texts have no words; texts shorter than a window lose nothing. Rows with
the same id are documents of equal rank: none removes words of another. A null id counts as the
largest id. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halala.llm.shared import written
from halala.llm.text import FIRST, SECOND, WHITE, Texts, Words, as_texts, list_sizes, ranges, run_starts, signed, slices

WINDOW, MINIMIZER = 50, 6
NO_ID = (1 << 63) - 1
_PLACE = np.uint64((1 << 28) - 1)

FRAGMENTS = "least bigint, whole bigint, id bigint, rank bigint, start int, n int, times int, before int, after int, place int, left_half int, right_half int"
WINDOWS = "least bigint, whole bigint, first_id bigint, at int, w1 bigint, w2 bigint"
KEPT = "id bigint, n_words bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values, by running minima of blocks from either end."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    block = padded.reshape(-1, width)
    forth = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], forth[width - 1 : n])


def _half(window: int, k: int) -> int:
    """The fewest words that every window has on one side of its minimizer."""
    return -(-(window - k) // 2)


def _halves(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, least: np.ndarray, window: int, k: int) -> list[np.ndarray]:
    """Hashes of the minimizer with half of a window's other words to its left, and to its right; 0 where a fragment ends before.

    Equal halves only let windows be compared, so 31 bits do; left ones are even, right ones odd.
    """
    half, found = _half(window, k), []
    for side, (a, b) in enumerate([(least - half, least + k), (least, least + k + half)]):
        inside = (a >= start) & (b <= end)
        out = np.zeros(len(start), np.int32)
        out[inside] = ((SECOND.runs(hashes, a[inside], b[inside]) >> np.uint64(33)).astype(np.int32) & ~1 | 2) + side
        found.append(out)
    return found


def _fragments_of(words: Words, window: int, k: int):
    """Row, first word, windows, minimizer, hash, place of the minimizer and halves of each fragment, in order of place."""
    hashes = words.hashes()
    at = run_starts(words, window)
    if not len(at):
        return None
    kmers = np.full(len(hashes), np.iinfo(np.uint64).max, np.uint64)
    places = run_starts(words, k)
    kmers[places] = SECOND.runs(hashes, places, places + k)
    keys = (kmers & ~_PLACE) | np.arange(len(kmers), dtype=np.uint64)
    chosen = (_least(keys, window - k + 1)[at] & _PLACE).astype(np.int64)
    rows = words.rows()[at]
    new = np.ones(len(at), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (chosen[1:] != chosen[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    start = at[first]
    whole = FIRST.runs(hashes, start, start + n + window - 1)
    halves = _halves(hashes, start, start + n + window - 1, chosen[first], window, k)
    return rows[first], start, n, kmers[chosen[first]], whole, chosen[first] - start, *halves


def _fragments(window: int, k: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            words = as_texts(piece.column("text")).words(~WHITE)
            found = _fragments_of(words, window, k)
            if found is None:
                continue
            rows, start, n, least, whole, *_ = found
            # The same fragment again and again (one word repeated) is one row.
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]) | (whole[1:] != whole[:-1]) | (start[1:] != start[:-1] + n[:-1])
            head = np.flatnonzero(new)
            times = np.diff(np.append(head, len(rows)))
            rows, start, n, least, whole, place, left_half, right_half = (x[head] for x in found)
            joined = rows[1:] == rows[:-1]
            # Neighbours only decide what is glued, so 31 bits of their hash do; 0 is none.
            short = ((whole >> np.uint64(33)) | np.uint64(1)).astype(np.int32)
            before, after = np.zeros(len(rows), np.int32), np.zeros(len(rows), np.int32)
            before[1:][joined], after[:-1][joined] = short[:-1][joined], short[1:][joined]
            start = start - words.first[rows]
            by_row = (piece.column(c).to_numpy(zero_copy_only=False)[rows] for c in ("id", "rank"))
            arrays = [signed(least), signed(whole), *by_row, start.astype(np.int32), n.astype(np.int32), times.astype(np.int32), before, after, place.astype(np.int32), left_half, right_half]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=[c.split()[0] for c in FRAGMENTS.split(", ")])

    return of_batches


def _flat(column: pa.Array) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """Row of each element of a list-of-struct column, and the fields of the elements; null is empty."""
    sizes = list_sizes(column)
    inner = column.flatten()
    return np.repeat(np.arange(len(column)), sizes), {f.name: inner.field(f.name) for f in inner.type}


def _windows(window: int):
    """The wanted windows of fragments, taken from the words at their source coordinates."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            words = as_texts(piece.column("text")).words(~WHITE)
            hashes = words.hashes()
            rows, wanted = _flat(piece.column("wanted"))
            n = wanted["n"].to_numpy()
            start = words.first[rows] + wanted["start"].to_numpy()
            each = np.repeat(np.arange(len(n)), n)
            at = ranges(n)
            begin = start[each] + at
            at += wanted["at"].to_numpy()[each]
            arrays = [wanted["least"].to_numpy()[each], wanted["whole"].to_numpy()[each], piece.column("id").to_numpy()[rows][each], at.astype(np.int32)]
            arrays += [signed(by.runs(hashes, begin, begin + window)) for by in (FIRST, SECOND)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], names=["least", "whole", "first_id", "at", "w1", "w2"])

    return of_batches


def _joined(texts: Texts, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Bytes of words, each followed by one space."""
    sizes = ends - starts + 1
    to = np.cumsum(sizes)
    index = np.repeat(starts - (to - sizes), sizes) + np.arange(int(to[-1]) if len(to) else 0)
    out = texts.data[np.minimum(index, max(len(texts.data) - 1, 0))].copy()
    out[to - 1] = 0x20
    return out


def _removed(piece: pa.RecordBatch, words: Words, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Which words lie in repeated passages, and the number of paths in each row."""
    spans, found = _flat(piece.column("spans"))
    change = np.zeros(len(words.starts) + 1, np.int64)
    paths = np.zeros(piece.num_rows, np.int64)
    if len(spans):
        field = {k: v.to_numpy(zero_copy_only=False) for k, v in found.items() if k != "early"}
        order = np.lexsort((field["start"], spans))
        field = {k: v[order] for k, v in field.items()}
        spans = spans[order]
        start = words.first[spans] + field["start"]
        end = start + field["n"] * field["times"]  # past the last window
        follows = np.zeros(len(spans), bool)
        follows[1:] = (start[1:] == end[:-1]) & (spans[1:] == spans[:-1])
        # Glued along a nonbranching path: the same neighbours wherever either fragment occurs.
        follows[1:] &= field["full"][1:] & field["full"][:-1] & field["one_before"][1:] & field["one_after"][:-1]
        full = np.flatnonzero(field["full"])
        heads = full[~follows[full]]
        last = np.append(np.flatnonzero(~follows)[1:], len(spans)) - 1
        tails = last[np.searchsorted(np.flatnonzero(~follows), heads)]
        np.add.at(change, start[heads], 1)
        np.add.at(change, end[tails] + window - 1, -1)
        np.add.at(paths, spans[heads], 1)
        early = found["early"].take(pa.array(order))
        # Windows that are repeats, in every repetition of their fragment.
        times = np.where(list_sizes(early) > 0, field["times"], 0)
        each = np.repeat(np.arange(len(spans)), times)
        early = early.take(pa.array(each))
        places = np.repeat(start[each] + ranges(times) * field["n"][each], list_sizes(early)) + early.flatten().to_numpy()
        np.add.at(change, places, 1)
        np.add.at(change, places + window, -1)
    return np.cumsum(change[:-1]) > 0, paths


def _keep(window: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches):
            texts = as_texts(piece.column("text"))
            words = texts.words(~WHITE)
            gone, paths = _removed(piece, words, window)
            kept = np.flatnonzero(~gone)
            sizes = words.ends - words.starts + 1
            bounds = np.concatenate([[0], np.cumsum(np.where(gone, 0, sizes))])[words.first]
            raw = _joined(texts, words.starts[kept], words.ends[kept]).tobytes()
            digests = [hashlib.sha256(raw[a : max(a, b - 1)]).hexdigest() for a, b in zip(bounds, bounds[1:], strict=False)]
            removed = np.concatenate([[0], np.cumsum(gone)])[words.first]
            yield pa.RecordBatch.from_arrays(
                [piece.column("id"), pa.array(words.counts()), pa.array(np.diff(removed)), pa.array(paths), pa.array(digests)],
                names=["id", "n_words", "n_removed", "n_spans", "kept_sha256"],
            )

    return of_batches


def _key(docs: DataFrame) -> DataFrame:
    """Documents by (id, rank): rank, 64 bits of the text, tells rows apart that repeat an id with another text."""
    return docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("rank"), "text")


def _one(column: str) -> Column:
    return (F.min(column) == F.max(column)) & (F.min(column) != 0)


def repeated_spans(keyed: DataFrame, window: int, k: int) -> DataFrame:
    """(id, rank, spans): per document the fragments that also start in a document with a smaller id.

    A span holds its first word, windows and repetitions; `full` when all its windows are repeats,
    else `early` lists those that are, in each repetition. one_before and one_after tell where paths do not branch.
    """
    found = keyed.mapInArrow(_fragments(window, k), FRAGMENTS)
    # Written first, so that the join has two plain sides whose hot minimizers Spark can split.
    shared = written(found.groupBy("least").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").select("least"))
    pieces = written(found.join(shared, "least"))
    graph = written(
        pieces.groupBy("least", "whole").agg(
            F.min("id").alias("first_id"), F.max("id").alias("last_id"), F.min(F.struct("id", "rank", "start", "n", "place")).alias("source"),
            _one("before").alias("one_before"), _one("after").alias("one_after"), F.min("left_half").alias("left_half"), F.min("right_half").alias("right_half"),
        )
    )
    halves = graph.select("least", "whole", "source", F.explode(F.array("left_half", "right_half")).alias("half")).where("half <> 0")
    forks = halves.groupBy("least", "half").agg(F.min("whole").alias("a"), F.max("whole").alias("b")).where("a <> b").select("least", "half")
    # Written first, like the minimizers.
    agreeing = halves.join(written(forks), ["least", "half"]).select("least", "whole", "source.*", "half")
    # Windows that reach as far to the left as a left half, or to the right as a right one.
    skip = F.when(F.col("half") % 2 == 0, 0).otherwise(F.greatest(F.lit(0), F.col("place") + (k + _half(window, k) - window)))
    upto = F.when(F.col("half") % 2 == 0, F.least("n", F.col("place") - (_half(window, k) - 1))).otherwise(F.col("n"))
    wanted = agreeing.select("id", "rank", F.struct("least", "whole", (F.col("start") + skip).alias("start"), (upto - skip).alias("n"), skip.alias("at")).alias("w"))
    wanted = wanted.groupBy("id", "rank").agg(F.collect_set("w").alias("wanted"))
    # Repeated rows, and both halves, give a window more than once, which the sets below take in.
    windows = written(keyed.join(wanted, ["id", "rank"]).mapInArrow(_windows(window), WINDOWS))
    firsts = windows.groupBy("w1", "w2").agg(F.min("first_id").alias("low"), F.max("first_id").alias("high")).where("low < high")
    late = windows.join(firsts, ["w1", "w2"]).where("first_id > low")
    late = late.groupBy("least", "whole").agg(F.collect_set("at").alias("early"))
    known = graph.join(late, ["least", "whole"], "left").where("first_id < last_id or early is not null")
    placed = pieces.join(known.select("least", "whole", "first_id", "early", "one_before", "one_after"), ["least", "whole"])
    full = F.col("id") > F.col("first_id")
    placed = placed.where(full | F.col("early").isNotNull())
    everywhere = F.col("early").isNotNull() & (F.size("early") == F.col("n"))
    span = F.struct("start", "n", "times", (full | everywhere).alias("full"), F.when(~full & ~everywhere, F.col("early")).alias("early"), "one_before", "one_after")
    return placed.groupBy("id", "rank").agg(F.collect_set(span).alias("spans"))


def without_repeats(docs: DataFrame, window: int = WINDOW, k: int = MINIMIZER) -> DataFrame:
    """(doc_id, n_words, n_removed, n_spans, kept_sha256) for every row of docs(doc_id, text, …)."""
    keyed = _key(docs)
    spans = repeated_spans(keyed, window, k)
    kept = keyed.join(spans, ["id", "rank"], "left").mapInArrow(_keep(window), KEPT)
    return kept.select(F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_words", "n_removed", "n_spans", "kept_sha256")
