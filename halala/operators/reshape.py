"""Set operations and wide-to-long reshaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stack_rows(*frames: DataFrame) -> DataFrame:
    """Union all by name."""
    return reduce(DataFrame.unionByName, frames)


def distinct_values(column: str, sources: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """Distinct non-NULL values over columns of several frames.

    Each source is reduced in its map tasks before the one shuffle.
    """
    parts = [df.select(F.col(name).alias(column)).where(F.col(column).isNotNull()) for df, name in sources]
    return stack_rows(*parts).distinct()


def columns_to_rows(
    df: DataFrame, keep: Sequence[str], labels: Mapping[str, str], label: str, value: str, value_type: str
) -> DataFrame:
    """One row per non-NULL labelled column, from a single scan."""
    wide = df.select(*keep, *[F.col(c).cast(value_type).alias(name) for c, name in labels.items()])
    return wide.unpivot(list(keep), list(labels.values()), label, value).where(F.col(value).isNotNull())
