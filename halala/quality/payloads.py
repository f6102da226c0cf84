"""Checks of delivered market documents, before they are loaded.

Each check yields one row per violation: file, rule and what it concerns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halala.functions.casts import boolean_or_null
from halala.functions.documents import document, explode_members, node_at, text_at, text_members
from halala.operators.reshape import stack_rows
from halala.plans.staging import PRICE_FIELDS, SERIES, VOLUME_FIELD

# What each feed must deliver.
FX_SYMBOLS = ["USD", "SAR", "GBP", "CHF"]
METAL_SYMBOLS = ["XAU", "XAG", "XPT", "XPD"]
EQUITY_TICKERS = ["AAPL", "MSFT", "SPY", "GLD", "GOOGL", "IBM", "SAP", "VOD"]

_NUMBERS = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL.*)$"


class PayloadError(Exception):
    """Raised with the violations found in delivered files."""


def rate_violations(raw: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """Exchange rate and metal documents: success, and a positive number for every symbol."""
    docs = raw.select("file_name", document("raw").alias("doc")).select(
        "file_name", "doc", F.coalesce(boolean_or_null(text_at("doc", "success")), F.lit(False)).alias("good")
    )

    def bad_rate(symbol: str) -> Column:
        node = node_at("doc", "rates", symbol)
        is_number = F.coalesce(F.schema_of_variant(node).rlike(_NUMBERS), F.lit(False))
        positive = F.coalesce(text_at("doc", "rates", symbol).try_cast("double") > 0, F.lit(False))
        return F.when(~(is_number & positive), F.lit(symbol))

    def violation(rule: str, subject: Column) -> Column:
        return F.struct(F.lit(rule).alias("rule"), subject.alias("subject"))

    # a failed response carries no rates, so only its failure is reported
    bad = F.filter(F.array(*[bad_rate(s) for s in symbols]), lambda s: s.isNotNull())
    found = F.when(~F.col("good"), F.array(violation("not_success", F.lit(None).cast("string")))).otherwise(
        F.transform(bad, lambda s: violation("missing_or_invalid_rate", s))
    )
    return docs.select("file_name", F.explode(found).alias("v")).select("file_name", "v.*")


def equity_violations(raw: DataFrame, tickers: Sequence[str]) -> DataFrame:
    """Equity documents: all tickers, a non-empty series each, five fields per day."""
    docs = raw.select("file_name", text_members("raw").alias("by_ticker"))
    wanted = F.array(*[F.lit(t) for t in tickers])
    missing = docs.select("file_name", F.explode(F.array_except(wanted, F.map_keys("by_ticker"))).alias("subject"))

    payloads = explode_members(docs, F.col("by_ticker"), "ticker", "payload").select("file_name", "ticker", "payload")
    series = F.from_json("payload", f"`{SERIES}` map<string,map<string,string>>")[SERIES]
    series = payloads.select("file_name", "ticker", series.alias("days"))
    empty = series.where(F.coalesce(F.size("days"), F.lit(0)) <= 0)

    days = explode_members(series, F.col("days"), "day", "bar")
    fields = F.array(*[F.lit(f) for f in [*PRICE_FIELDS.values(), VOLUME_FIELD]])
    gaps = days.select(
        "file_name", "ticker", "day", F.explode(F.array_except(fields, F.map_keys("bar"))).alias("missing")
    )

    def labelled(df: DataFrame, rule: str, subject: Column) -> DataFrame:
        return df.select("file_name", F.lit(rule).alias("rule"), subject.alias("subject"))

    return stack_rows(
        labelled(missing, "missing_ticker", F.col("subject")),
        labelled(empty, "no_series", F.col("ticker")),
        labelled(gaps, "missing_field", F.concat_ws("/", "ticker", "day", "missing")),
    )


def refuse(violations: DataFrame, shown: int = 20) -> None:
    """Raise when there is any violation, naming the first ones."""
    first = violations.limit(shown + 1).collect()
    if first:
        lines = [" ".join(str(v) for v in row) for row in first[:shown]]
        raise PayloadError("\n".join(lines + ["..."] * (len(first) > shown)))
