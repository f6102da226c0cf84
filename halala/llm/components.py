"""Connected components of a graph given as rows, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halala.llm.shared import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Link the neighbours of each node to the least of them and the node: the larger neighbours, or the others.

    The hub of a star is the smaller end, so a star with millions of rays costs map-side minima and
    joins that Spark splits by size; no group is gathered.
    """
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    pairs = both if large else edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    joined = pairs.join(least, "a")
    if large:
        moved = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
    return moved.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each node of an edge (a, b) reaches.

    Nulls and loops link nothing. Rounds go on until no edge moves; each is written to the shared
    folder. The number of rounds grows with the logarithm of the longest path.
    """
    now = written(edges.select("a", "b").where("a <> b").distinct())
    mark = None
    while True:
        now = written(_star(_star(now, large=True), large=False))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
