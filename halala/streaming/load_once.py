"""Every landed file is loaded into RAW at most once.

`load_feed` is the default: a streaming file source whose checkpoint remembers the files; a run takes
what is new and ends. `load_manifest` loads exactly the files a table of paths names, `load_listed` those
of a list. All may load into the same RAW table.

Each batch is a folder of its own below the table, and a few rows in the load log beside it: a row per
file, with its number of rows. The log is the commit: a batch counts once its log rows are there, and a
file whose name the log holds is left out, also when the content changed or the checkpoint is new. RAW
itself is never read to find out what was loaded.

A file with violations stays outside as a whole, while the other files of its batch are loaded. Its
violations are recorded once, in a folder per batch; a corrected delivery of the file is taken by the next run.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halala.operators.lookup import checked_broadcast, settle
from halala.quality.payloads import PayloadError
from halala.session import STORED
from halala.sources.warehouse import BATCH

# The file source forgets files older than this against the newest one, and would skip a file
# that arrives late with an old modification time.
_REMEMBER = "36500d"

LOADS = "batch string, file_name string, row_count bigint, loaded_at timestamp"
VIOLATIONS = "check string, file_name string, rule string, subject string, found_at timestamp"
FEW = 1_000  # files that are read by name; more are read by folder
KEPT_BATCHES = 64  # log folders before they are merged
SHOWN = 20  # violations named in an error

Check = Callable[[DataFrame], DataFrame | None]


def _stored(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    reader = spark.read.schema(schema) if schema else spark.read
    try:
        return reader.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _log_path(target: str) -> str:
    return f"{target.rstrip('/')}.loads"


def loads(spark: SparkSession, target: str) -> DataFrame:
    """(batch, file_name, row_count, loaded_at): what was loaded into a RAW table.

    A table that is older than its log gets one, from its rows, when it is first asked for.
    """
    log = _stored(spark, _log_path(target), LOADS)
    if log is not None:
        return log.select("batch", "file_name", "row_count", "loaded_at").distinct()  # merged folders may still be there too
    rows = _stored(spark, target)
    if rows is None or BATCH not in rows.columns:
        return spark.createDataFrame([], LOADS)
    loaded_at = "loaded_at" if "loaded_at" in rows.columns else "_loaded_at"
    counted = rows.groupBy(F.col(BATCH).cast("string").alias("batch"), "file_name")
    known = counted.agg(F.count(F.lit(1)).alias("row_count"), F.max(loaded_at).alias("loaded_at"))
    known.write.mode("ignore").parquet(f"{_log_path(target)}/slot=before")
    return loads(spark, target)


def _log(rows: DataFrame, target: str, slot: str) -> None:
    """Commit a batch, whose rows are stored: one folder of log rows, in place of one that died half-way."""
    counted = rows.groupBy("file_name").agg(F.count(F.lit(1)).alias("row_count"))
    entries = counted.select(F.lit(slot).alias("batch"), "file_name", "row_count", F.current_timestamp().alias("loaded_at"))
    entries.coalesce(1).write.mode("overwrite").parquet(f"{_log_path(target)}/slot={slot}")


def merge_log(spark: SparkSession, target: str, kept: int = KEPT_BATCHES) -> bool:
    """Merge the log's folders into one when there are more than `kept`; readers see the same rows throughout."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_log_path(target))
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    old = [x.getPath() for x in files.listStatus(path)] if files.exists(path) else []
    if len(old) <= kept:
        return False
    loads(spark, target).write.parquet(f"{_log_path(target)}/slot=merged-{uuid.uuid4().hex}")
    for folder in old:
        files.delete(folder, True)
    return True


def raw_rows(spark: SparkSession, target: str) -> DataFrame | None:
    """Rows of the committed batches of a RAW table, or None before its first batch."""
    rows = _stored(spark, target)
    if rows is None or BATCH not in rows.columns or _stored(spark, _log_path(target)) is None:
        return None if rows is None else rows.drop(BATCH)
    batches = loads(spark, target).select(F.col("batch").alias("_slot")).distinct()
    return rows.join(F.broadcast(batches), F.col(BATCH).cast("string") == F.col("_slot"), "left_semi").drop(BATCH)


def _not_loaded(rows: DataFrame, target: str, slot: str = "") -> DataFrame:
    """Rows of files that no other batch has loaded."""
    known = loads(rows.sparkSession, target).where(F.col("batch") != slot).select("file_name").distinct()
    # a name per file: shuffled by it, the rows of a large file would meet in one task
    return rows.join(checked_broadcast(known), "file_name", "left_anti").select(*rows.columns)


def _store(
    rows: DataFrame, target: str, slot: str, check: Check | None, prepare: Callable[[DataFrame], DataFrame] | None, keep: str | None, name: str
) -> list[str]:
    """Store the rows of files that pass as one batch; returns accounts of the first violations of the others."""
    spark, lines = rows.sparkSession, []
    found = check(rows) if check else None
    if found is not None:
        told = found.select(F.lit(name).alias("check"), "file_name", "rule", F.col("subject").cast("string").alias("subject")).distinct()
        told = settle(told.withColumn("found_at", F.current_timestamp()))
        first = told.drop("check", "found_at").limit(SHOWN + 1).collect()
        if first:
            if keep:
                told.write.mode("overwrite").parquet(f"{keep}/slot={slot}")
            rows = rows.join(checked_broadcast(told.select("file_name").distinct()), "file_name", "left_anti").select(*rows.columns)
            lines = [" ".join(str(v) for v in row) for row in first[:SHOWN]] + ["..."] * (len(first) > SHOWN)
    place = f"{target}/{BATCH}={slot}"
    (prepare(rows) if prepare else rows).write.mode("overwrite").options(**STORED).parquet(place)
    _log(spark.read.schema("file_name string").parquet(place), target, slot)
    return lines


def load_feed(
    spark: SparkSession,
    read_files: Callable[..., DataFrame],
    landing: str,
    target: str,
    checkpoint: str,
    files_per_batch: int = 10_000,
    check: Check | None = None,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    keep: str | None = None,
    name: str = "",
) -> None:
    """Load the new files of one landing folder into the RAW table at `target`.

    `check` sees the rows of a batch's new files and returns violations (file_name, rule, subject): the
    files they name are refused, and the violations stored at `keep` under the feed's `name`. What it raises
    refuses the whole batch. `prepare` turns rows into RAW rows. A batch that died half-way is repeated into
    the folder it had, which is named after the checkpoint and the batch. After all is loaded, refused files
    raise PayloadError.
    """

    failed: list[Exception] = []
    refused: list[str] = []

    def commit(batch: DataFrame, number: int) -> None:
        query = batch.sparkSession.read.text(f"{checkpoint}/metadata").select(F.get_json_object("value", "$.id")).first()[0]
        slot = f"{query}-{number}"
        try:
            refused.extend(_store(_not_loaded(batch, target, slot), target, slot, check, prepare, keep, name))
        except Exception as reason:
            failed.append(reason)
            raise

    reader = spark.readStream.option("maxFileAge", _REMEMBER).option("maxFilesPerTrigger", files_per_batch)
    query = (
        read_files(reader, landing)
        .writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException:
        if failed:
            raise failed[0] from None
        raise
    corrected = _corrected(spark, landing, target, keep, name) if keep else None
    if corrected is not None:
        refused += _load(spark, read_files, corrected, target, f"again-{uuid.uuid4().hex}", check, prepare, keep, name)
    merge_log(spark, target)
    if refused:
        raise PayloadError("\n".join(refused))


def landed_files(spark: SparkSession, folder: str | Sequence[str], pattern: str = "*") -> DataFrame:
    """(path, file_name, modified_at) of the files below folders; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return files.select("path", F.substring_index("path", "/", -2).alias("file_name"), F.col("modificationTime").alias("modified_at"))


def stored_violations(spark: SparkSession, keep: str) -> DataFrame:
    """What the loads have recorded, a row for each file, rule and subject of a batch."""
    told = _stored(spark, keep, VIOLATIONS)
    columns = [c.split()[0] for c in VIOLATIONS.split(", ")]
    return spark.createDataFrame([], VIOLATIONS) if told is None else told.select(*columns)


def _corrected(spark: SparkSession, landing: str, target: str, keep: str, name: str) -> DataFrame | None:
    """Refused files that were delivered again since, or None without any."""
    told = stored_violations(spark, keep)
    open_ = _not_loaded(told.where(F.col("check") == name).groupBy("file_name").agg(F.max("found_at").alias("found_at")), target)
    if open_.isEmpty():
        return None
    again = landed_files(spark, landing).join(open_, "file_name").where("modified_at > found_at")
    return again.select("path", "file_name")


def _load(spark, read_files, files: DataFrame, target: str, slot: str, check=None, prepare=None, keep=None, name: str = "") -> list[str]:
    """Load the files (path, file_name) that are not loaded yet, as one batch."""
    files = settle(_not_loaded(files, target).dropDuplicates(["file_name"]))
    some = [r["path"] for r in files.limit(FEW + 1).select("path").collect()]
    if not some:
        return []
    if len(some) > FEW:
        # folders are far fewer than files
        some = [r[0] for r in files.select(F.regexp_replace("path", "/[^/]*$", "")).distinct().collect()]
    read = read_files(spark.read, some)
    wanted = read.join(checked_broadcast(files.select("file_name")), "file_name", "left_semi").select(*read.columns)
    return _store(wanted, target, slot, check, prepare, keep, name)


def load_manifest(spark: SparkSession, read_files: Callable[..., DataFrame], files: DataFrame, target: str) -> DataFrame:
    """Append the files of a manifest (path, …) that are not in the RAW table yet; returns their log rows.

    The manifest is compared with the log where it lies; of more than `FEW` new files only the folders
    are handed to the reader.
    """
    slot = f"listed-{uuid.uuid4().hex}"
    _load(spark, read_files, files.select("path", F.substring_index("path", "/", -2).alias("file_name")), target, slot)
    merge_log(spark, target)
    return loads(spark, target).where(F.col("batch") == slot)


def load_listed(
    spark: SparkSession,
    read_files: Callable[..., DataFrame],
    paths: Sequence[str],
    target: str,
) -> list[str]:
    """The same for a list of paths; returns those it loaded."""
    listed = spark.createDataFrame([(p,) for p in paths], "path string")
    loaded = {r["file_name"] for r in load_manifest(spark, read_files, listed, target).collect()}  # no more than were passed in
    return sorted({p for p in paths if "/".join(p.split("/")[-2:]) in loaded})


def load_history(raw: DataFrame, table: str, loaded_at: str = "loaded_at") -> DataFrame:
    """Files a RAW table holds, with their rows and load time.

    Derived from the table itself, so it can never disagree with it.
    """
    return raw.groupBy("file_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.max(loaded_at).alias("loaded_at")
    ).select(F.lit(table).alias("table_name"), "file_name", "row_count", "loaded_at")
