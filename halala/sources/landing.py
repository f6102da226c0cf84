"""Delivered files as RAW rows: whole JSON documents, and ledger batches with all columns as text.

Every function takes a reader (`spark.read` or `spark.readStream`), so batch and streaming loads
share one definition. A malformed file fails the load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halala.functions.documents import one_object
from halala.schemas import LEDGER_FILE, LEDGER_KEPT_COLUMNS


def landed_name() -> Column:
    """Feed folder and file name, the identity of a landed file."""
    return F.substring_index(F.col("_metadata.file_path"), "/", -2)


def batch_id_of(file_name: Column) -> Column:
    """File name without folder and extension."""
    return F.split_part(F.split_part(file_name, F.lit("/"), F.lit(-1)), F.lit("."), F.lit(1))


def document_files(reader, paths) -> DataFrame:
    """One row per JSON file."""
    text = reader.format("text").option("wholetext", True).option("pathGlobFilter", "*.json").load(paths)
    checked = F.when(one_object("value"), F.col("value")).otherwise(
        F.raise_error(F.concat(F.lit("not one JSON object: "), landed_name()))
    )
    return text.select(
        checked.alias("raw"),
        landed_name().alias("file_name"),
        F.current_timestamp().alias("loaded_at"),
    )


def _ledger_text(reader, paths) -> DataFrame:
    return (
        reader.schema(LEDGER_FILE)
        .format("csv")
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "FAILFAST")
        .option("columnPruning", False)  # else short lines and headers pass unseen
        .option("quote", '"')
        .option("escape", '"')
        .option("pathGlobFilter", "*.csv")
        .load(paths)
    )


def delivered_lines(reader, paths) -> DataFrame:
    """All columns of the ledger lines as delivered, for the checks before a load."""
    return _ledger_text(reader, paths).select("*", landed_name().alias("file_name"))


def ledger_files(reader, paths) -> DataFrame:
    """One row per ledger line, as text. Missing or reordered columns fail the load.

    Quotes are doubled inside quoted values. A line break inside a value also fails the load, so
    that a large batch file can still be split over tasks.
    """
    return ledger_rows(ledger_deliveries(reader, paths))


def ledger_deliveries(reader, paths) -> DataFrame:
    """All columns of the ledger lines as delivered, with the columns that a load adds."""
    return _ledger_text(reader, paths).select(
        "*",
        batch_id_of(F.col("_metadata.file_path")).alias("batch_id"),
        landed_name().alias("file_name"),
        F.current_timestamp().alias("_loaded_at"),
    )


def ledger_rows(deliveries: DataFrame) -> DataFrame:
    """RAW rows of delivered ledger lines."""
    return deliveries.select(*LEDGER_KEPT_COLUMNS, "batch_id", "file_name", "_loaded_at")


def sample_documents(spark, folder: str) -> DataFrame:
    """Replay of a folder of payloads in name order; an empty folder is an error."""
    docs = document_files(spark.read, folder)
    if docs.isEmpty():
        raise FileNotFoundError(f"no JSON documents in {folder}")
    return docs.orderBy("file_name")
