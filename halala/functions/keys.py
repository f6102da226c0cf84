"""Surrogate and calendar keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from halala.functions.casts import as_column

# Stand-in for NULL and separator inside a surrogate key.
NULL_MARK = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"


def hashed(text: Column | str) -> Column:
    return F.md5(as_column(text).cast("string"))


def surrogate_key(*columns: Column | str) -> Column:
    parts = [F.coalesce(as_column(c).cast("string"), F.lit(NULL_MARK)) for c in columns]
    return F.md5(F.concat_ws(KEY_SEPARATOR, *parts))


_DIGEST = r"\A[0-9a-f]{32}\z"
_PADDING = "\0" * 16


def packed(key: Column | str) -> Column:
    """A key as bytes that differ for different keys: a digest as its 16 bytes, half of what its text takes when moved.

    Other keys are their own bytes; those that could be taken for a digest or a padded key are padded.
    """
    key = as_column(key)
    alike = (F.octet_length(key) == 16) | key.endswith("\0")
    digest = (F.octet_length(key) == 32) & key.rlike(_DIGEST)
    return F.when(digest, F.unhex(key)).when(alike, F.concat(key, F.lit(_PADDING)).cast("binary")).otherwise(key.cast("binary"))


def unpacked(key: Column | str) -> Column:
    """The key that was packed."""
    key = as_column(key)
    padded = F.substring(key, F.octet_length(key), F.lit(1)) == F.lit(b"\0")
    own = F.when(padded, F.substring(key, F.lit(1), F.octet_length(key) - len(_PADDING))).otherwise(key)
    return F.when(F.octet_length(key) == 16, F.lower(F.hex(key))).otherwise(own.cast("string"))


def date_key(day: Column | str) -> Column:
    """YYYYMMDD as an integer."""
    day = as_column(day)
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")
