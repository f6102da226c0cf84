"""Joins of a large side with a lookup side that may be small.

A lookup is broadcast only after its rows and bytes were counted: while it was written, where the
library wrote it (`measured_write`), else by a job of its own. Beyond the bound the join is left to Spark:
a shuffled join whose hot keys AQE splits (the large side is always the left, which a left or inner join
may split).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from halala.session import STORED, scratch_path

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 * 1024 * 1024


# Rows and bytes of frames that the library wrote and measured; a frame is forgotten with its last user.
_SIZES: WeakKeyDictionary[DataFrame, tuple[int, int]] = WeakKeyDictionary()


def remember_size(df: DataFrame, rows: int, bytes_: int) -> DataFrame:
    """Note that the frame has at most so many rows and bytes; columns picked from it have no more."""
    _SIZES[df] = rows, bytes_
    return df


def known_size(df: DataFrame) -> tuple[int, int] | None:
    return _SIZES.get(df)


def rows_of(*frames: DataFrame) -> int | None:
    """Rows of the frames together, at most; None when one was not measured."""
    sizes = [known_size(df) for df in frames]
    return None if None in sizes else sum(rows for rows, _ in sizes)


def measured_write(df: DataFrame, write: Callable[[DataFrame], None]) -> dict[str, int]:
    """Write the rows and count them, with their bytes, in the same pass."""
    size = Observation()
    write(df.observe(size, F.count(F.lit(1)).alias("n_rows"), F.sum(row_bytes(df)).alias("n_bytes")))
    return {"n_rows": size.get["n_rows"], "n_bytes": size.get["n_bytes"] or 0}


def settle(df: DataFrame) -> DataFrame:
    """Compute once, as a Parquet table in the shared folder, and go on from there.

    Lost executors then cost nothing of the work before it, and later reads take only the columns
    they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark)
    size = measured_write(df, lambda rows: rows.write.options(**STORED).parquet(path))
    return remember_size(spark.read.schema(df.schema).parquet(path), size["n_rows"], size["n_bytes"])


def _text_bytes(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        return reduce(add, [_text_bytes(column[f.name], f.dataType) for f in kind], F.lit(16 * len(kind)))
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0))
    if isinstance(kind, (T.ArrayType, T.MapType, T.VariantType)):
        return F.coalesce(F.octet_length(F.to_json(column)), F.lit(0)) * 4
    return F.lit(0)


def row_bytes(df: DataFrame) -> Column:
    """About the bytes of a row in memory."""
    texts = [_text_bytes(F.col(f.name), f.dataType) for f in df.schema]
    return reduce(add, texts, F.lit(16 * len(df.columns))).cast("bigint")


def is_small(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    known = known_size(df)
    if known is not None and known[0] <= max_rows and known[1] <= max_bytes:
        return True
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("bytes")).first()
    return size["n"] <= max_rows and (size["bytes"] or 0) <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df


def pick(df: DataFrame, *columns: Column | str) -> DataFrame:
    """Columns of a frame, which has the size of the whole at most."""
    picked, size = df.select(*columns), known_size(df)
    return picked if size is None else remember_size(picked, *size)


def attach(
    facts: DataFrame,
    lookup: DataFrame,
    on: str,
    lookup_on: str,
    bring: Sequence[str],
    how: str = "left",
) -> DataFrame:
    """Star join: bring columns of a dimension next to each fact row."""
    narrow = pick(lookup, F.col(lookup_on).alias("_on"), *bring)
    return facts.join(checked_broadcast(narrow), facts[on] == F.col("_on"), how).drop("_on")
