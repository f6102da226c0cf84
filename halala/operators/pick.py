"""One row per key: the latest copy, or the preferred source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """First row per key. NULL keys form a group of their own.

    Spark limits each key to one row inside every map task before the shuffle
    (WindowGroupLimit), so a key that holds a third of all copies stays cheap.
    """
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).where("_position = 1").drop("_position")


def latest_by(df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]) -> DataFrame:
    """Latest copy per key; later columns of `newest_first` break ties."""
    return first_by(df, keys, [F.col(c).desc_nulls_last() for c in newest_first])


def prefer_by(df: DataFrame, keys: Sequence[str], priority: Sequence[str]) -> DataFrame:
    """Row of the lowest priority number per key; later columns break ties."""
    return first_by(df, keys, [F.col(c).asc_nulls_last() for c in priority])
