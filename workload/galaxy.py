"""The thirteen tables as registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halala.plans import staging
from workload import inputs
from workload.galaxy_sql import with_blocks
from workload.inputs import Galaxy, epoch_of
from workload.registry import register


def whole(column: str, digits: int = 0):
    """Double rounded so that the order of a floating-point sum cannot show."""
    return F.round(F.col(column).cast("double"), digits).alias(column)


def plain_rates(rates: DataFrame) -> DataFrame:
    return rates.select(
        "rate_date",
        epoch_of("rate_timestamp").alias("rate_epoch"),
        "base_currency",
        "target_currency",
        F.col("exchange_rate").cast("double").alias("exchange_rate"),
        "file_name",
    )


def plain_metals(metals: DataFrame) -> DataFrame:
    prices = ["gold_usd", "silver_usd", "platinum_usd", "palladium_usd"]
    return metals.select(
        "success",
        "base_currency",
        epoch_of("api_timestamp").alias("api_epoch"),
        *[F.col(p).cast("double").alias(p) for p in prices],
        "file_name",
    )


def plain_ledger(ledger: DataFrame) -> DataFrame:
    for amount in ["quantity", "price", "fees"]:
        ledger = ledger.withColumn(amount, F.col(amount).cast("double"))
    epoch = epoch_of("transaction_ts").alias("transaction_epoch")
    return ledger.select("*", epoch).drop("transaction_ts", "_loaded_at")


@register(
    "stg_exchange_rates",
    with_blocks("""
    SELECT day AS rate_date, epoch(day) + 86399 AS rate_epoch, base AS base_currency, code AS target_currency,
           CAST(rate AS DOUBLE) AS exchange_rate,
           'exchange_rates/' || day || '-' || status || '.json' AS file_name
    FROM fx_latest"""),
)
def stg_exchange_rates(spark: SparkSession, folder: str) -> DataFrame:
    return plain_rates(staging.stg_exchange_rates(inputs.fx_rates_raw(spark, folder)))


@register(
    "stg_precious_metals",
    with_blocks("""
    SELECT NOT failed AS success, 'USD' AS base_currency,
           epoch(day) + CASE status WHEN 'P' THEN 43199 ELSE 86399 END AS api_epoch,
           CAST(xau AS DOUBLE) AS gold_usd, CAST(xag AS DOUBLE) AS silver_usd,
           CAST(xpt AS DOUBLE) AS platinum_usd, CAST(xpd AS DOUBLE) AS palladium_usd,
           'metal_prices/' || day || '-' || status || '.json' AS file_name
    FROM metal_latest"""),
)
def stg_precious_metals(spark: SparkSession, folder: str) -> DataFrame:
    return plain_metals(staging.stg_precious_metals(inputs.metal_prices_raw(spark, folder)))


@register(
    "stg_equity_prices",
    with_blocks("""
    SELECT ticker, day AS date, low AS open_price, high AS high_price, low AS low_price, high AS close_price, volume,
           'equity_prices/' || ticker || '-' || status || '.json' AS file_name, 'alpha_vantage' AS source
    FROM equity_price"""),
)
def stg_equity_prices(spark: SparkSession, folder: str) -> DataFrame:
    return staging.stg_equity_prices(inputs.equity_prices_raw(spark, folder)).drop("loaded_at")


@register(
    "stg_ledger_transactions",
    with_blocks("""
    SELECT transaction_id, client_id, client_name, portfolio_id, ticker, side AS transaction_type,
           CAST(quantity AS DOUBLE) AS quantity, CAST(price AS DOUBLE) AS price, CAST(fees AS DOUBLE) AS fees,
           currency_code, epoch(shipped) + 34200 AS transaction_epoch, day AS transaction_date,
           strftime(shipped, '%Y%m%d') || 'T093000' AS batch_id
    FROM trade"""),
)
def stg_ledger_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return plain_ledger(staging.stg_ledger_transactions(inputs.ledger_transactions_raw(spark, folder)))


@register(
    "int_fx_rates_to_sar",
    with_blocks("SELECT rate_date, currency_code, round(rate_to_sar, 9) AS rate_to_sar FROM sar"),
)
def int_fx_rates_to_sar(spark: SparkSession, folder: str) -> DataFrame:
    return Galaxy(spark, folder).int_fx_rates_to_sar.select("rate_date", "currency_code", whole("rate_to_sar", 9))


@register(
    "dim_asset",
    with_blocks("SELECT asset_key, ticker, ticker AS asset_name, asset_type, sector FROM asset"),
)
def dim_asset(spark: SparkSession, folder: str) -> DataFrame:
    return Galaxy(spark, folder).dim_asset


@register("dim_client", with_blocks("SELECT client_key, client_id, client_name FROM client"))
def dim_client(spark: SparkSession, folder: str) -> DataFrame:
    return Galaxy(spark, folder).dim_client


@register("dim_currency", with_blocks("SELECT currency_key, currency_code FROM currency"))
def dim_currency(spark: SparkSession, folder: str) -> DataFrame:
    return Galaxy(spark, folder).dim_currency


@register(
    "dim_date",
    with_blocks("""
    SELECT date_key, full_date, year(full_date) AS year, quarter(full_date) AS quarter,
           month(full_date) AS month, day(full_date) AS day
    FROM calendar"""),
)
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return Galaxy(spark, folder).dim_date


@register(
    "dim_source_usage",
    with_blocks("""
    SELECT md5(s.source_name) AS source_key, s.source_name, s.source_type, count(m.price) AS prices
    FROM (VALUES ('Internal Ledger', 'Internal'), ('EQUITY_API', 'External'),
                 ('Metal Market Data', 'External')) AS s(source_name, source_type)
    LEFT JOIN market AS m ON m.source_name = s.source_name
    GROUP BY ALL"""),
)
def dim_source_usage(spark: SparkSession, folder: str) -> DataFrame:
    """The constant dimension, with the market prices each source delivered."""
    galaxy = Galaxy(spark, folder)
    used = galaxy.fact_market_prices.groupBy("source_key").agg(F.count("price").alias("prices"))
    return galaxy.dim_source.join(used, "source_key", "left").fillna(0, ["prices"])


def rounded_holdings(holdings: DataFrame) -> DataFrame:
    plain = ["quantity", "signed_quantity", "price", "fees", "transaction_value"]
    return holdings.withColumns(
        {
            **{c: F.col(c).cast("double") for c in plain},
            "exchange_rate": F.round("exchange_rate", 9),
            "value_sar": F.round("value_sar", 0),
        }
    )


@register(
    "fact_holdings",
    with_blocks("""
    SELECT holding_key, date_key, asset_key, client_key, currency_key, side AS transaction_type,
           CAST(quantity AS DOUBLE) AS quantity,
           CAST(CASE side WHEN 'BUY' THEN quantity ELSE -quantity END AS DOUBLE) AS signed_quantity,
           CAST(price AS DOUBLE) AS price, round(rate_to_sar, 9) AS exchange_rate, rate_date AS fx_rate_date,
           CAST(fees AS DOUBLE) AS fees, CAST(value AS DOUBLE) AS transaction_value,
           round(value_sar, 0) AS value_sar
    FROM holding"""),
)
def fact_holdings(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_holdings(Galaxy(spark, folder).fact_holdings)


@register(
    "fact_market_prices",
    with_blocks("""
    SELECT md5(asset_key || '-' || date_key || '-' || md5(source_name)) AS market_price_key,
           asset_key, date_key, md5('USD') AS currency_key, md5(source_name) AS source_key, price,
           round(rate_to_sar, 9) AS exchange_rate, rate_date AS fx_rate_date, round(price_sar, 1) AS price_sar
    FROM market"""),
)
def fact_market_prices(spark: SparkSession, folder: str) -> DataFrame:
    prices = Galaxy(spark, folder).fact_market_prices.drop("loaded_at")
    return prices.withColumns({"exchange_rate": F.round("exchange_rate", 9), "price_sar": F.round("price_sar", 1)})


SUMMARY_SQL = """
    SELECT md5(coalesce(client_key, '_dbt_utils_surrogate_key_null_') || '-' ||
               coalesce(CAST(date_key AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS portfolio_summary_key,
           date_key, client_key,
           CAST(round(CAST(invested AS DECIMAL(38,4)), 0) AS DOUBLE) AS total_investment,
           CAST(round(CAST(value AS DECIMAL(38,4)), 0) AS DOUBLE) AS portfolio_value_sar,
           CAST(fees AS DOUBLE) AS total_fees,
           CAST(round(CAST(change AS DECIMAL(38,6)), 4) AS DOUBLE) AS daily_return,
           CAST(round(CAST(value - invested AS DECIMAL(38,4)), 0) AS DOUBLE) AS pnl_sar,
           CAST(round(CAST(value AS DECIMAL(38,4)), 0) AS DOUBLE) AS currency_exposure_sar
    FROM summary"""


def rounded_summary(summary: DataFrame) -> DataFrame:
    money = ["total_investment", "portfolio_value_sar", "pnl_sar", "currency_exposure_sar"]
    return summary.withColumns(
        {
            **{c: F.round(c, 0).cast("double") for c in money},
            "total_fees": F.col("total_fees").cast("double"),
            "daily_return": F.round("daily_return", 4).cast("double"),
        }
    )


@register("fact_daily_portfolio_summary", with_blocks(SUMMARY_SQL))
def fact_daily_portfolio_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded_summary(Galaxy(spark, folder).fact_daily_portfolio_summary)


@register(
    "summary_first_rows",
    with_blocks(f"SELECT * FROM ({SUMMARY_SQL}) AS s ORDER BY date_key, client_key LIMIT 10"),
)
def summary_first_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The analyst's first look at the summary: ten rows, in a stated order."""
    summary = fact_daily_portfolio_summary(spark, folder)
    return summary.orderBy(F.col("date_key").asc_nulls_last(), F.col("client_key").asc_nulls_last()).limit(10)


# Stored tables as their queries return them.
COMPARABLE = {
    "stg_exchange_rates": plain_rates,
    "stg_precious_metals": plain_metals,
    "stg_ledger_transactions": plain_ledger,
    "fact_holdings": rounded_holdings,
    "fact_daily_portfolio_summary": rounded_summary,
}
