"""Documents that every corpus operator must stand, and plain versions of what operators compute."""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, id long, rank long, node long, bucket int, score double, label int"

LONG = " ".join(f"w{i % 997} x{i % 31}" for i in range(30_000))

ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away from here today", "en"),
    (2, "The quick brown fox jumps over the lazy dog and runs far away from here today", "en"),
    (2, "The quick brown fox jumps over the lazy dog and runs far away from here today", "en"),
    (3, "", None),
    (4, None, "de"),
    (None, "ohne Kennung steht hier ein kurzer Satz", "de"),
    (None, None, None),
    (5, " \t\n ", "en"),
    (6, "é ü 漢字 \u00a0 \u3000 ß 🙂 end", "fr"),
    (7, LONG, "en"),
    (8, LONG, None),
    (9, "one", "en"),
    (10, "!!! ... 123", "en"),
    (2, "another text under a used number", "en"),
]


def odd(spark: SparkSession, rows=tuple(ODD)) -> DataFrame:
    """The rows with extra columns whose names the operators use inside."""
    full = [(i, t, g, "s", None if t is None else len(t), 0, 0, 0, 0, 0.5, 1) for i, t, g in rows]
    return spark.createDataFrame(full, SCHEMA)


def lower(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def texts(values: list[str | None]) -> pa.Array:
    return pa.array(values, pa.string())
