"""Keep a table of latest copies up to date from a stream of deliveries.

A batch is merged only with the partitions it touches. Each merge happens in two steps, so that a
run that dies at any point can be repeated: the merged partitions are written to a slot first, and
then published from there. A mark of the checkpoint and batch follows the slot; a repeated batch
finds its own mark and only publishes again. Another checkpoint's batches never find it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halala.operators.pick import latest_by
from halala.sources.warehouse import in_partitions

_MARK = "checkpoint string, batch bigint"


def _stored(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def latest_copy_merge(
    target: str, slots: str, keys: Sequence[str], newest_first: Sequence[str], partition: str, checkpoint: str
) -> Callable[[DataFrame, int], None]:
    """`foreachBatch` function that merges deliveries into the table at `target`.

    `partition` must follow from the keys, so that all copies of a key share a partition.
    `checkpoint` is the checkpoint location of the query that calls it.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # two slots in turn: the other one still serves the previous batch
        slot, marks = f"{slots}/{batch_id % 2}", f"{slots}/mark-{batch_id % 2}"
        name = spark.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
        mark = _stored(spark, marks, _MARK)
        done = mark is not None and [(name, batch_id)] == [tuple(r) for r in mark.collect()]
        if not done:
            rows, stored = batch, _stored(spark, target)
            if stored is not None:
                rows = rows.unionByName(in_partitions(stored, partition, batch).select(*batch.columns))
            latest_by(rows, keys, newest_first).write.mode("overwrite").parquet(slot)
            spark.createDataFrame([(name, batch_id)], _MARK).coalesce(1).write.mode("overwrite").parquet(marks)
        merged = spark.read.schema(batch.schema).parquet(slot)
        publish = merged.hint("rebalance", partition).write.mode("overwrite").partitionBy(partition)
        publish.option("partitionOverwriteMode", "dynamic").parquet(target)

    return merge
