"""Text to typed columns: a value that does not parse becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spark also reads '2026' and '2026-01' as dates; a delivered date must name its day.
_FULL_DATE = r"^\s*\d{1,7}-\d{1,2}-\d{1,2}"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def decimal_or_null(text: Column | str, scale: int) -> Column:
    return as_column(text).try_cast(f"decimal(38,{scale})")


def double_or_null(text: Column | str) -> Column:
    return as_column(text).try_cast("double")


def bigint_or_null(text: Column | str) -> Column:
    return as_column(text).try_cast("bigint")


def boolean_or_null(text: Column | str) -> Column:
    return as_column(text).try_cast("boolean")


def date_or_null(text: Column | str) -> Column:
    text = as_column(text)
    return F.when(text.rlike(_FULL_DATE), text.try_cast("date"))


def naive_timestamp_or_null(text: Column | str) -> Column:
    """Wall-clock timestamp from ISO text; the offset after second 19 is cut off."""
    clipped = F.left(as_column(text), F.lit(19))
    return F.when(clipped.rlike(_FULL_DATE), clipped.try_cast("timestamp_ntz"))


def epoch_to_naive(seconds: Column | str) -> Column:
    """Epoch seconds to a naive UTC timestamp. Not a try: a non-numeric epoch fails the job."""
    since = F.make_dt_interval(secs=as_column(seconds).cast("bigint"))
    return F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + since
