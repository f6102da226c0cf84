"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halala.functions.keys import date_key, hashed
from halala.operators.reshape import distinct_values, stack_rows

# Metal tickers, sector of each known ticker, and the data providers.
METALS = ["XAU", "XAG", "XPT", "XPD"]
SECTORS = {
    "METALS": ["XAU", "XAG", "XPT", "XPD"],
    "TECHNOLOGY": ["AAPL", "MSFT", "GOOGL", "IBM", "SAP"],
    "TELECOMMUNICATIONS": ["VOD"],
    "ETF": ["GLD", "SPY"],
}
OTHER_SECTOR = "OTHER"
PROVIDERS = [
    ("Internal Ledger", "Internal"),
    ("EQUITY_API", "External"),
    ("Metal Market Data", "External"),
]

# Which source names a ticker's type: metals first, then priced equities, then traded tickers.
_METAL, _PRICED, _TRADED = 0, 1, 2


def _sector(ticker):
    named = F.lit(OTHER_SECTOR)
    for sector, tickers in reversed(SECTORS.items()):
        named = F.when(ticker.isin(tickers), sector).otherwise(named)
    return named


def dim_asset(stg_equity: DataFrame, stg_ledger: DataFrame) -> DataFrame:
    """Every ticker that is priced, traded, or a known metal."""
    metals = stg_ledger.sparkSession.createDataFrame([(m,) for m in METALS], "ticker string")
    seen = stack_rows(
        metals.withColumn("priority", F.lit(_METAL)),
        stg_equity.select("ticker", F.lit(_PRICED).alias("priority")),
        stg_ledger.select("ticker", F.lit(_TRADED).alias("priority")),
    ).where("ticker is not null")
    # min() combines inside the map tasks, so a ticker traded in a third of all rows is cheap
    best = seen.groupBy("ticker").agg(F.min("priority").alias("priority"))
    return best.select(
        hashed("ticker").alias("asset_key"),
        "ticker",
        F.col("ticker").alias("asset_name"),
        F.when(F.col("priority") == _METAL, "METAL").otherwise("EQUITY").alias("asset_type"),
        _sector(F.col("ticker")).alias("sector"),
    )


def dim_client(stg_ledger: DataFrame) -> DataFrame:
    """Distinct clients; a renamed client has one row per name."""
    named = stg_ledger.select("client_id", "client_name").where("client_id is not null").distinct()
    return named.select(hashed("client_id").alias("client_key"), "client_id", "client_name")


def dim_currency(stg_ledger: DataFrame, stg_fx: DataFrame, fx_to_sar: DataFrame) -> DataFrame:
    codes = distinct_values(
        "currency_code",
        [(stg_ledger, "currency_code"), (stg_fx, "target_currency"), (fx_to_sar, "currency_code")],
    )
    return codes.select(hashed("currency_code").alias("currency_key"), "currency_code")


def dim_date(stg_ledger: DataFrame, stg_equity: DataFrame, stg_metals: DataFrame, stg_fx: DataFrame) -> DataFrame:
    """One row per day on which a trade, quote or rate is dated; the parts are computed from the day."""
    metal_days = stg_metals.select(F.col("api_timestamp").cast("date").alias("day"))
    days = distinct_values(
        "full_date",
        [(stg_ledger, "transaction_date"), (stg_equity, "date"), (metal_days, "day"), (stg_fx, "rate_date")],
    )
    return days.select(
        date_key("full_date").alias("date_key"),
        "full_date",
        *[
            part("full_date").cast("bigint").alias(name)
            for name, part in [("year", F.year), ("quarter", F.quarter), ("month", F.month), ("day", F.dayofmonth)]
        ],
    )


def dim_source(spark: SparkSession) -> DataFrame:
    providers = spark.createDataFrame(PROVIDERS, "source_name string, source_type string")
    return providers.select(hashed("source_name").alias("source_key"), "source_name", "source_type")
