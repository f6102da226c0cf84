"""What the corpus operators share: given tables, texts in small batches, and intermediate tables in the shared folder."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from halala.session import scratch_path

BATCH, BATCH_SETTING = "4m", "spark.sql.execution.arrow.maxBytesPerBatch"


def given(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def written(rows: DataFrame) -> DataFrame:
    """The rows as a Parquet table in the shared folder: computed once, and safe from lost executors."""
    spark = rows.sparkSession
    path = scratch_path(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def over_texts(rows: DataFrame, of_batches: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | object) -> DataFrame:
    """rows.mapInArrow in batches of about `BATCH` bytes, unless the session names another size.

    A task holds a batch in the JVM and in its worker, and while a batch is filled its buffers are there
    twice; with Spark's 64 MB these are the texts of whole tasks.
    """
    conf = rows.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, BATCH)
    return rows.mapInArrow(of_batches, schema)
