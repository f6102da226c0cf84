"""Typed, deduplicated views over the RAW tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halala.functions.casts import (
    bigint_or_null,
    boolean_or_null,
    date_or_null,
    decimal_or_null,
    double_or_null,
    epoch_to_naive,
    naive_timestamp_or_null,
)
from halala.functions.documents import document, explode_members, members, node_at, text_at, text_members
from halala.operators.pick import latest_by

# Newest delivery first; equal load times fall back to the file name.
DELIVERY = ["loaded_at", "file_name"]

# Output column and quote key of each metal (USD per troy ounce).
METAL_QUOTES = {
    "gold_usd": "USDXAU",
    "silver_usd": "USDXAG",
    "platinum_usd": "USDXPT",
    "palladium_usd": "USDXPD",
}

# Member names of an equity document, and the provider they come from.
SERIES = "Time Series (Daily)"
NOT_A_TICKER = "Meta Data"
EQUITY_PROVIDER = "alpha_vantage"
PRICE_FIELDS = {
    "open_price": "1. open",
    "high_price": "2. high",
    "low_price": "3. low",
    "close_price": "4. close",
}
VOLUME_FIELD = "5. volume"


def stg_exchange_rates(fx_rates_raw: DataFrame) -> DataFrame:
    """One row per date, base and target currency, from successful documents only."""
    docs = fx_rates_raw.select("file_name", "loaded_at", document("raw").alias("doc"))
    # success decides inside the explode: as a filter it would be pushed down and parse a second time
    succeeded = boolean_or_null(text_at("doc", "success"))
    headed = docs.select(
        date_or_null(text_at("doc", "date")).alias("rate_date"),
        epoch_to_naive(F.when(succeeded, text_at("doc", "timestamp"))).alias("rate_timestamp"),
        text_at("doc", "base").alias("base_currency"),
        F.when(succeeded, members(node_at("doc", "rates"))).alias("quotes"),
        "file_name",
        "loaded_at",
    )
    quotes = explode_members(headed, F.col("quotes"), "target_currency", "quote")
    typed = quotes.withColumn("exchange_rate", decimal_or_null("quote", 6)).select(
        "rate_date",
        "rate_timestamp",
        "base_currency",
        "target_currency",
        "exchange_rate",
        "file_name",
        "loaded_at",
    )
    return latest_by(typed, ["rate_date", "base_currency", "target_currency"], DELIVERY)


def stg_precious_metals(metal_prices_raw: DataFrame) -> DataFrame:
    """One row per API timestamp. Failed documents take part, so a later one hides a good one."""
    docs = metal_prices_raw.select("file_name", "loaded_at", document("raw").alias("doc"))
    typed = docs.select(
        boolean_or_null(text_at("doc", "success")).alias("success"),
        text_at("doc", "base").alias("base_currency"),
        epoch_to_naive(text_at("doc", "timestamp")).alias("api_timestamp"),
        *[decimal_or_null(text_at("doc", "rates", quote), 12).alias(name) for name, quote in METAL_QUOTES.items()],
        "file_name",
        "loaded_at",
    )
    return latest_by(typed, ["api_timestamp"], DELIVERY)


def stg_equity_prices(equity_prices_raw: DataFrame) -> DataFrame:
    """Daily bars out of the nested series; of several copies of a ticker's day the last loaded counts."""
    origin = ["file_name", "loaded_at"]
    by_ticker = explode_members(
        equity_prices_raw.select("raw", *origin), text_members("raw"), "ticker", "payload"
    ).where(F.col("ticker") != NOT_A_TICKER)
    series = F.from_json("payload", f"`{SERIES}` map<string,map<string,string>>")[SERIES]
    by_day = explode_members(by_ticker.select("ticker", "payload", *origin), series, "day", "bar")
    typed = by_day.select(
        "ticker",
        date_or_null("day").alias("date"),
        *[double_or_null(F.col("bar")[field]).alias(name) for name, field in PRICE_FIELDS.items()],
        bigint_or_null(F.col("bar")[VOLUME_FIELD]).alias("volume"),
        "file_name",
        F.lit(EQUITY_PROVIDER).alias("source"),
        "loaded_at",
    )
    return latest_by(typed, ["ticker", "date"], DELIVERY)


def stg_ledger_transactions(ledger_transactions_raw: DataFrame) -> DataFrame:
    """Typed ledger, one row per RAW row."""
    return ledger_transactions_raw.select(
        "transaction_id",
        "client_id",
        "client_name",
        "portfolio_id",
        "ticker",
        "transaction_type",
        decimal_or_null("quantity", 4).alias("quantity"),
        decimal_or_null("price", 4).alias("price"),
        decimal_or_null("fee_amount", 4).alias("fees"),
        F.col("currency").alias("currency_code"),
        naive_timestamp_or_null("transaction_ts").alias("transaction_ts"),
        date_or_null("transaction_date").alias("transaction_date"),
        "batch_id",
        "_loaded_at",
    )
