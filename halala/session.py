"""Session settings the engine relies on, and the shared folder for cut lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Only settings that change results or scale behaviour; sizing stays with the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


# How tables are stored: keys are digests in hexadecimal, which zstd halves and Spark's default leaves as they are.
STORED = {"compression": "zstd"}


def build_session(app_name: str = "halala", master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, "spark.ui.enabled": "false", **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it in spark.checkpoint.dir.

    A temporary folder is made only in local mode, where all tasks share one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    in_use = spark.sparkContext.getCheckpointDir()
    if in_use:
        return in_use.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="halala-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession) -> str:
    """A new folder name below the shared folder."""
    return f"{shared_folder(spark)}/halala/{uuid.uuid4().hex}"
