"""Document fingerprints by consistent weighted sampling, in DataFrame expressions only.

Terms are the words of a text, weighted by how often they occur times the square of their length,
since long words tell more. For every sample and term a hash gives r and c, distributed as
Gamma(2, 1), and b, uniform; with t = floor(ln(weight) / r + b) the term with the least
ln(c) - r * (t - b + 1) is drawn, and (term, t) is the sample. Two texts share a sample with a chance
equal to their generalised Jaccard similarity, the sum of the least weights over that of the largest.
A fingerprint is the 16-bit hashes of `SAMPLES` samples, in hexadecimal.

Each text is also compared with its follower by id. Documents are dealt into buckets of ids by
quantiles, and those of an id with many rows (or of none) by their texts' hashes; each bucket gets a copy of the next one's first document, so that the follower of every
document is found within its bucket and texts are shuffled once.

Edge cases: null is the empty text; texts without words share one fingerprint, so two of them are
alike. Repeated rows follow each other; repeated ids are ordered by a hash of the text. A null id
comes last. The last document is followed by the first; a single one by itself. Extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections import Counter

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SAMPLES = 32
BUCKET_ROWS, MOST_BUCKETS = 250, 4096
NO_ID = (1 << 63) - 1

# -ln of 64 evenly spaced chances: the sum of two is a Gamma(2, 1) value.
_LOGS = [-math.log((i + 0.5) / 64) for i in range(64)]


def _bits(x: Column, shift: int, n: int) -> Column:
    return F.shiftrightunsigned(x, shift).bitwiseAND(F.lit((1 << n) - 1))


def _draw(j: int, term: Column, log_weight: Column, logs: Column) -> Column:
    """Order and hash of a term in sample j, in one number: the least over terms is the sample."""
    h = F.xxhash64(term, F.lit(j))
    chance = (_bits(h, 0, 20) + 0.5) * (_bits(h, 20, 20) + 0.5) / float(1 << 40)
    r = F.get(logs, _bits(h, 40, 6).cast("int")) + F.get(logs, _bits(h, 46, 6).cast("int"))
    b = (_bits(h, 52, 12) + 0.5) / 4096.0
    t = F.floor(log_weight / r + b)
    order = F.log(-F.log(chance)) - r * (t - b + 1)
    place = F.floor((order + 64.0) * float(1 << 23)).cast("bigint")  # order lies between -40 and 5
    return F.shiftleft(place, 32) + F.xxhash64(term, t, F.lit(j)).bitwiseAND(F.lit(0xFFFFFFFF))


def _terms(text: Column) -> Column:
    """Sorted hashes of the words; the lowest 5 bits hold the length, up to 31."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.sort_array(F.transform(words, lambda w: F.xxhash64(w).bitwiseAND(F.lit(-32)).bitwiseOR(F.least(F.length(w), F.lit(31)).cast("bigint"))))


def _weighted(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, side, term, n): the distinct terms of texts(keys, side, body) and how often they occur; null for none."""
    sorted_terms = texts.select(*keys, "side", _terms(F.col("body")).alias("terms"))
    at = F.filter(F.sequence(F.lit(0), F.size("terms") - 1), lambda i: (i == 0) | (F.get("terms", i) != F.get("terms", i - 1)))
    starts = sorted_terms.withColumn("at", F.when(F.size("terms") > 0, at))
    pairs = F.transform("at", lambda i, k: F.struct(F.get("terms", i).alias("term"), (F.coalesce(F.get("at", k + 1), F.size("terms")) - i).alias("n")))
    return starts.select(*keys, "side", F.inline_outer(pairs))


def _samples(terms: DataFrame, keys: list[str], count: int) -> DataFrame:
    """(keys, side, samples): the drawn hash of every sample."""
    size = F.col("term").bitwiseAND(F.lit(31))
    weighed = terms.withColumn("log_weight", F.log(F.col("n") * size * size))
    logs = F.array(*map(F.lit, _LOGS))
    drawn = [F.min(_draw(j, F.col("term"), F.col("log_weight"), logs)).alias(f"s{j}") for j in range(count)]
    short = [F.coalesce(_bits(F.col(f"s{j}"), 0, 16), F.lit(0)).cast("int") for j in range(count)]
    return weighed.groupBy(*keys, "side").agg(*drawn).select(*keys, "side", F.array(*short).alias("samples"))


def likeness(a: str, b: str, count: int) -> Column:
    """Share of equal samples."""
    same = F.filter(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.get(a, i) == F.get(b, i))
    return F.size(same) / float(count)


def _text_of(samples: str) -> Column:
    return F.array_join(F.transform(samples, lambda x: F.lpad(F.lower(F.hex(x)), 4, "0")), "")


def _bounds(quantiles: list[int]) -> list[tuple[int, int]]:
    """Cuts in the order of (id, rank); an id that is several quantiles is cut by rank, evenly, as many times."""
    times = Counter(quantiles)
    return [(i, (j + 1) * (1 << 64) // (times[i] + 1) - (1 << 63)) for i in sorted(times) for j in range(times[i])]


def _bucket_of(cuts: list[tuple[int, int]]) -> Column:
    ids, ranks = (F.array(*(F.lit(c[k]).cast("bigint") for c in cuts)) for k in (0, 1))
    both = F.arrays_zip(ids.alias("i"), ranks.alias("r"))
    return F.size(F.filter(both, lambda x: (x["i"] < F.col("id")) | ((x["i"] == F.col("id")) & (x["r"] < F.col("rank")))))


def _bucketed(docs: DataFrame) -> DataFrame:
    """Rows (bucket, id, rank, added, text): all documents, and at each bucket's end the next one's first."""
    base = docs.select(F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)).alias("id"), F.xxhash64("text").alias("rank"), F.coalesce("text", F.lit("")).alias("text"))
    rows = base.count()
    count = min(MOST_BUCKETS, rows // BUCKET_ROWS + 1)
    cuts = []
    if count > 1:
        shares = [i / count for i in range(1, count)]
        cuts = _bounds(base.agg(F.percentile_approx("id", shares, 20 * count)).first()[0])
    base = base.withColumn("bucket", F.lit(0) if not cuts else _bucket_of(cuts))
    # One row per bucket, at most MOST_BUCKETS: the first document of each, and the bucket before it.
    firsts = base.groupBy("bucket").agg(F.min(F.struct("id", "rank")).alias("first")).orderBy("bucket").collect()
    order = [r["bucket"] for r in firsts]
    known = [(order[i - 1], r["first"]["id"], r["first"]["rank"]) for i, r in enumerate(firsts)]
    heads = docs.sparkSession.createDataFrame(known, "bucket int, id bigint, rank bigint")
    texts = base.drop("bucket").join(F.broadcast(heads), ["id", "rank"]).groupBy("bucket").agg(F.min("text").alias("text"))
    added = texts.select("bucket", F.lit(0).cast("bigint").alias("id"), F.lit(0).cast("bigint").alias("rank"), F.lit(1).alias("added"), "text")
    return base.select("bucket", "id", "rank", F.lit(0).alias("added"), "text").union(added)


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) for every row.

    The edited text is the text whose last quarter gives way to as many first characters of the next.
    """
    order = Window.partitionBy("bucket").orderBy("added", "id", "rank")
    placed = _bucketed(docs).select("*", F.row_number().over(order).alias("seq"), F.lead("text").over(order).alias("next"))
    n = F.length("text")
    edited = F.when(F.col("added") == 0, F.concat(F.expr("substring(text, 1, length(text) - length(text) div 4)"), F.expr("substring(next, 1, length(text) div 4)")))
    rows = placed.select("bucket", "seq", "added", "id", n.cast("bigint").alias("n_chars"), "text", edited.alias("edited"))
    rows = rows.withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256))
    keys = ["bucket", "seq", "added", "id", "n_chars", "edited_sha256"]
    sides = F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("text").alias("body")), F.struct(F.lit(1).alias("side"), F.col("edited").alias("body"))))
    both = rows.select(*keys, sides.alias("s")).select(*keys, "s.side", "s.body").where("side = 0 or added = 0")
    drawn = _samples(_weighted(both, keys), keys, samples)
    paired = drawn.groupBy(*keys).agg(*(F.max(F.when(F.col("side") == i, F.col("samples"))).alias(c) for i, c in ((0, "own"), (1, "other"))))
    following = Window.partitionBy("bucket").orderBy("seq")
    compared = paired.withColumn("follower", F.lead("own").over(following)).where("added = 0")
    return compared.select(
        F.when(F.col("id") != NO_ID, F.col("id")).alias("doc_id"), "n_chars", "edited_sha256",
        _text_of("own").alias("fingerprint"), _text_of("other").alias("edited_fingerprint"),
        likeness("own", "other", samples).alias("near_edited"), likeness("own", "follower", samples).alias("near_next"),
    )
