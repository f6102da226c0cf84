"""Phrases that belong together, by stripes: each first word keys counters of what follows it.

A stripe of the prefix `a` holds, for every next word b, how often "a b" occurs, and for every word c after
that, how often "a b c" does. Tasks build the stripes of their slice of texts (`numbered`), shards of
prefixes merge them element by element, and a merged stripe gives at once the extensions of a phrase, the
totals of its prefixes, and the largest count among the phrases that extend it to the right. What extends a
phrase to the left is in another stripe and is looked up among the candidates, which are few.

A stripe of a frequent prefix is dealt to several shards by its next word, one for each `HOT` occurrences;
each next word's own counter stays whole. A word or phrase is one entry a slice, however often it occurs.

Edge cases: null, empty and blank texts have no words; a null language is "und". Repeated rows count as
often as they occur. Punctuation alone separates pieces and is in no phrase. An empty table, or one without
phrases that are frequent enough, gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from halala.llm.numbered import SLICE, Numbering, answers_of, bucketed, by_number, local, merged, numbers, of_answers, pack, pack_keys, shard_bits, unpack
from halala.llm.shared import written
from halala.llm.text import Texts, as_texts, mix, slices, strings

HOT = 1 << 20
STRIPES = 1 << 19  # phrases that a shard gets, about
LEAST, SHARE, TOP = 10, 50, 2000
UNKNOWN = "und"

BREAK = np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?"]] = True
BREAK[0x0A:0x0E] = True
IN_WORD = ~BREAK
IN_WORD[[0x20, 0x09]] = False

SLICES = "part string, slice bigint, keys binary, counts binary, n_keys int, tokens binary, n_tokens bigint, pieces binary, n_pieces int, words array<string>"
SENT = "part string, shard bigint, slice bigint, n int, longer int, packed binary"
FOUND = "part string, a bigint, b bigint, c bigint, f bigint, left bigint, f_first bigint, f_last bigint, extended bigint"


def _slice(texts: Texts) -> dict | None:
    words = texts.words(IN_WORD)
    if not len(words.starts):
        return None
    distinct, first, place = local(words.hashes())
    broken = np.concatenate([[0], np.cumsum(BREAK[texts.data])])
    new = np.ones(len(place), bool)
    rows = words.rows()
    new[1:] = (rows[1:] != rows[:-1]) | (broken[words.starts[1:]] != broken[words.ends[:-1]])
    pieces = np.diff(np.append(np.flatnonzero(new), len(new)))
    sizes = words.ends[first] - words.starts[first]
    to = np.cumsum(sizes)
    raw = texts.data[np.repeat(words.starts[first] - (to - sizes), sizes) + np.arange(int(to[-1]))]
    named = strings(raw, np.concatenate([[0], to]))
    counts = np.bincount(place, minlength=len(distinct)).astype(np.int64)
    return {"keys": pack_keys(distinct), "counts": pack(counts), "n_keys": len(distinct), "tokens": pack(place), "n_tokens": len(place), "pieces": pack(pieces), "n_pieces": len(pieces), "words": named}


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = Numbering()
    kinds = {"keys": pa.binary(), "counts": pa.binary(), "tokens": pa.binary(), "n_keys": pa.int32(), "pieces": pa.binary(), "n_pieces": pa.int32()}
    for piece in slices(batches, limit=SLICE):
        names = piece.column("part")
        for part in names.unique().to_pylist():
            row = _slice(as_texts(piece.column("text").filter(pa.array(np.array([x == part for x in names.to_pylist()], bool))), lower=True))
            if row is None:
                continue
            named = row.pop("words")
            arrays = [pa.array([part], pa.string()), pa.array([number()]), *(pa.array([v], kinds.get(k)) for k, v in row.items())]
            arrays.append(pa.ListArray.from_arrays(pa.array([0, len(named)], pa.int32()), named))
            yield pa.RecordBatch.from_arrays(arrays, names=["part", "slice", *row, "words"])


def stripes_of(places: np.ndarray, pieces: np.ndarray, words: int) -> tuple[np.ndarray, ...]:
    """Stripes of one slice: (a, b, times) of its pairs in order, and (pair, c, times) of what follows them."""
    inner = np.ones(len(places), bool)
    inner[np.cumsum(pieces) - pieces] = False  # the first word of a piece follows none
    at = np.flatnonzero(inner)
    pairs, pair, times = np.unique(places[at - 1] * words + places[at], return_inverse=True, return_counts=True)
    second = np.flatnonzero(inner[at - 1])  # pairs that follow a pair
    longer, often = np.unique(pair[second - 1] * words + places[at[second]], return_counts=True)
    return pairs // words, pairs % words, times, longer // words, longer % words, often


def _send(bits: int):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                number, counts = of_answers(batch.column("numbers")[i], 2)
                places = unpack(batch.column("tokens")[i].as_buffer(), batch.column("n_tokens")[i].as_py())[0].astype(np.int64)
                places, number, counts = by_number(places, number, counts)
                pieces = unpack(batch.column("pieces")[i].as_buffer(), batch.column("n_pieces")[i].as_py())[0].astype(np.int64)
                a, b, times, pair, c, often = stripes_of(places, pieces, len(number))
                if not len(a):
                    continue
                shard = (mix(number[a].astype(np.uint64)) >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(a), np.int64)
                dealt = (mix(number[b].astype(np.uint64)) >> np.uint64(20)).astype(np.int64) % (1 + counts[a] // HOT)
                shard = (shard + dealt) & ((1 << bits) - 1)
                order = np.argsort(shard, kind="stable")
                below = np.argsort(shard[pair], kind="stable")
                children = np.bincount(pair, minlength=len(a))[order]
                ends = np.concatenate([[0], np.cumsum(children)])
                cuts = np.append(np.flatnonzero(np.diff(shard[order], prepend=-1)), len(order))
                rows = []
                for x, y in zip(cuts, cuts[1:], strict=False):
                    own, more = order[x:y], below[ends[x] : ends[y]]
                    steps = np.diff(number[a[own]], prepend=0)  # ascending
                    raw = pack(steps, number[b[own]], times[own], counts[a[own]], counts[b[own]], children[x:y], number[c[more]], often[more], counts[c[more]])
                    rows.append((int(shard[order[x]]), y - x, len(more), raw))
                shards, n, longer, raw = (list(x) for x in zip(*rows, strict=True))
                part = [batch.column("part")[i].as_py()] * len(rows)
                arrays = [pa.array(part, pa.string()), pa.array(shards, pa.int64()), pa.array([batch.column("slice")[i].as_py()] * len(rows), pa.int64())]
                yield pa.RecordBatch.from_arrays([*arrays, pa.array(n, pa.int32()), pa.array(longer, pa.int32()), pa.array(raw, pa.binary())], names=["part", "shard", "slice", "n", "longer", "packed"])

    return of_batches


def _merge(least: int):
    """Stripes of one shard added up; phrases of `least` occurrences and more, with what the stripe tells of them."""

    def of_shard(rows: pa.Table) -> pa.Table:
        pairs, longer, before = [], [], 0
        for raw, n, m in zip(rows.column("packed"), rows.column("n").to_pylist(), rows.column("longer").to_pylist(), strict=True):
            *own, children, c, often, f_c = (x.astype(np.int64) for x in unpack(raw.as_buffer(), *[n] * 6, m, m, m))
            own[0] = np.cumsum(own[0])
            pairs.append(own)
            longer.append([np.repeat(np.arange(before, before + n), children), c, often, f_c])
            before += n
        a, b, times, f_a, f_b = (np.concatenate(x) for x in zip(*pairs, strict=True))
        above, c, often, f_c = (np.concatenate(x) for x in zip(*longer, strict=True))
        first, pair = merged([a, b])
        total = np.bincount(pair, times, len(first)).astype(np.int64)
        a, b, f_a, f_b = (x[first] for x in (a, b, f_a, f_b))
        head, place = merged([pair[above], c]) if len(above) else (np.zeros(0, np.int64),) * 2
        sums = np.bincount(place, often, len(head)).astype(np.int64)
        above, c, f_c = pair[above][head], c[head], f_c[head]
        two, three = np.flatnonzero(total >= least), np.flatnonzero(sums >= least)
        up = above[three]
        most = np.zeros(len(a), np.int64)
        np.maximum.at(most, up, sums[three])
        columns = [
            np.concatenate(x)
            for x in ((a[two], a[up]), (b[two], b[up]), (total[two], sums[three]), (f_a[two], total[up]), (f_a[two], f_a[up]), (f_b[two], f_c[three]), (most[two], np.zeros(len(up), np.int64)))
        ]
        third = pa.array(np.concatenate([np.zeros(len(two), np.int64), c[three]]), mask=np.arange(len(two) + len(up)) < len(two))
        names = pa.array([rows.column("part")[0].as_py()] * len(columns[0]), pa.string())
        a, b, f, left, f_first, f_last, extended = map(pa.array, columns)
        return pa.table([names, a, b, third, f, left, f_first, f_last, extended], names=["part", "a", "b", "c", "f", "left", "f_first", "f_last", "extended"])

    return of_shard


def _words(least: int):
    """(part, number, word) of every word with `least` occurrences, from the one slice that owns it."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                answers = batch.column("numbers")[i]
                number, counts = of_answers(answers, 2)
                owned = np.concatenate([np.unpackbits(np.frombuffer(x["owned"], np.uint8), count=x["n"]) for x in answers.as_py()])
                some = np.flatnonzero((owned == 1) & (counts >= least))
                words = batch.column("words")[i].values.take(pa.array(some))
                yield pa.RecordBatch.from_arrays([pa.array([batch.column("part")[i].as_py()] * len(some), pa.string()), pa.array(number[some]), words], names=["part", "number", "word"])

    return of_batches


def _score(left: str, right: str) -> Column:
    """floor(1000000 * f * f / (left * right)) without rounding, of counts up to 10**15."""
    top = "cast(1000000 as decimal(7,0)) * cast(f as decimal(15,0)) * cast(f as decimal(15,0))"
    return F.expr(f"({top}) div (cast({left} as decimal(19,0)) * cast({right} as decimal(19,0)))")


def candidates(docs: DataFrame, least: int = LEAST, each: int = STRIPES) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent phrases of docs(text, lang, …) as rows of `FOUND`, the words behind their numbers, and words per language."""
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("part"), "text")
    sliced = bucketed(rows.mapInArrow(_slices, SLICES), "slice")
    totals = sliced.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    answers = written(numbers(sliced)[0])
    mine = sliced.join(answers_of(answers, "numbers", "packed", "owned"), "slice")
    bits = shard_bits(sliced.agg(F.sum("n_tokens")).first()[0] or 0, each)
    sent = mine.select("part", "slice", "tokens", "n_tokens", "pieces", "n_pieces", "numbers").mapInArrow(_send(bits), SENT)
    found = written(sent.groupBy("part", "shard").applyInArrow(_merge(least), FOUND))
    named = mine.select("part", "words", "numbers").mapInArrow(_words(least), "part string, number bigint, word string")
    return found, named, totals


def collocations(docs: DataFrame, least: int = LEAST, share: int = SHARE, top: int = TOP, each: int = STRIPES) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of two and three words of each language.

    A phrase with `least` occurrences is scored by its weakest cut; it is left out when a longer one around
    it has at least `share` percent of its occurrences.
    """
    found, named, totals = candidates(docs, least, each)
    two, three = found.where("c is null"), found.where("c is not null")

    # Two words: extensions to the right are known from the stripe, those to the left come from the longer phrases.
    around = three.select("part", F.col("b").alias("a"), F.col("c").alias("b"), "f").groupBy("part", "a", "b").agg(F.max("f").alias("around"))
    kept = two.join(around, ["part", "a", "b"], "left").where(f"100 * greatest(extended, coalesce(around, 0)) < {share} * f")
    pairs = kept.select("part", "a", "b", "c", "f", F.col("f_first").alias("l"), F.col("f_last").alias("r"), _score("f_first", "f_last").alias("score"))

    # Three words: the count of the last two is that of another candidate.
    ends = two.select("part", F.col("a").alias("b"), F.col("b").alias("c"), F.col("f").alias("right"))
    cut = three.join(ends, ["part", "b", "c"]).withColumns({"one": _score("f_first", "right"), "two": _score("left", "f_last")})
    first = F.col("one") <= F.col("two")
    triples = cut.select(
        "part", "a", "b", "c", "f", F.when(first, F.col("f_first")).otherwise(F.col("left")).alias("l"),
        F.when(first, F.col("right")).otherwise(F.col("f_last")).alias("r"), F.least("one", "two").alias("score"),
    )

    # Words are looked up for the rows that can be among the first only; ties in score and count all can.
    best = Window.partitionBy("part").orderBy(F.desc("score"), F.desc("f"))
    likely = written(pairs.unionByName(triples).withColumn("at", F.rank().over(best)).where(F.col("at") <= top).drop("at"))
    wanted = likely.select("part", F.explode(F.array("a", "b", "c")).alias("number")).where("number is not null").distinct()
    words = written(named.join(wanted, ["part", "number"]))
    for column in ("a", "b", "c"):
        likely = likely.join(words.withColumnsRenamed({"number": column, "word": f"word_{column}"}), ["part", column], "left")
    phrased = likely.withColumn("phrase", F.concat_ws(" ", "word_a", "word_b", "word_c"))
    place = F.row_number().over(Window.partitionBy("part").orderBy(F.desc("score"), F.desc("f"), "phrase"))
    ranked = phrased.withColumn("rank", place).where(F.col("rank") <= top)
    sums = ranked.join(totals, "part")
    return sums.select(F.col("part").alias("lang"), F.col("rank").cast("bigint").alias("rank"), "phrase", F.col("f").alias("a"), "l", "r", "n", "score")
