"""Fact tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from halala.functions.amounts import exact_product, relative_change, signed_quantity
from halala.functions.keys import hashed, packed, surrogate_key, unpacked
from halala.operators.asof import asof_join
from halala.operators.lookup import attach, known_size, pick, settle
from halala.operators.pick import latest_by
from halala.operators.reshape import columns_to_rows

# Tickers of the metal columns, price currency and source names.
METAL_TICKERS = {
    "gold_usd": "XAU",
    "silver_usd": "XAG",
    "platinum_usd": "XPT",
    "palladium_usd": "XPD",
}
PRICE_CURRENCY = "USD"
EQUITY_SOURCE = "EQUITY_API"
METAL_SOURCE = "Metal Market Data"

FX_COLUMNS = {"rate_date": "fx_rate_date", "rate_to_sar": "exchange_rate"}


def fact_holdings(
    stg_ledger: DataFrame,
    fx_to_sar: DataFrame,
    dim_date: DataFrame,
    dim_asset: DataFrame,
    dim_client: DataFrame,
    dim_currency: DataFrame,
) -> DataFrame:
    """Ledger lines with dimension keys and values in both currencies.

    The as-of join supplies the rate; where it finds none, what depends on it is NULL.
    """
    rows = asof_join(stg_ledger, fx_to_sar, ["currency_code"], "transaction_date", "rate_date", FX_COLUMNS)
    rows = attach(rows, dim_date, "transaction_date", "full_date", ["date_key"])
    rows = attach(rows, dim_asset, "ticker", "ticker", ["asset_key"])
    rows = attach(rows, dim_client, "client_id", "client_id", ["client_key"])
    rows = attach(rows, dim_currency, "currency_code", "currency_code", ["currency_key"])
    value = exact_product("quantity", "price")
    return rows.select(
        hashed("transaction_id").alias("holding_key"),
        "date_key",
        "asset_key",
        "client_key",
        "currency_key",
        "transaction_type",
        "quantity",
        signed_quantity("transaction_type", "quantity").alias("signed_quantity"),
        "price",
        "exchange_rate",
        "fx_rate_date",
        "fees",
        value.alias("transaction_value"),
        (value * F.col("exchange_rate")).alias("value_sar"),
    )


def quoted_prices(stg_equity: DataFrame, stg_metals: DataFrame) -> DataFrame:
    """Equity closes and metal quotes as one long list of USD prices."""
    equities = stg_equity.select(
        "ticker",
        "date",
        F.col("close_price").alias("price"),
        F.lit(EQUITY_SOURCE).alias("source_name"),
        "loaded_at",
        F.col("date").cast("timestamp_ntz").alias("observed_at"),
    )
    metals = columns_to_rows(
        stg_metals.where("success"), ["api_timestamp", "loaded_at"], METAL_TICKERS, "ticker", "price", "double"
    ).select(
        "ticker",
        F.col("api_timestamp").cast("date").alias("date"),
        "price",
        F.lit(METAL_SOURCE).alias("source_name"),
        "loaded_at",
        F.col("api_timestamp").alias("observed_at"),
    )
    return equities.unionByName(metals).withColumn("currency_code", F.lit(PRICE_CURRENCY))


def fact_market_prices(
    stg_equity: DataFrame,
    stg_metals: DataFrame,
    fx_to_sar: DataFrame,
    dim_asset: DataFrame,
    dim_date: DataFrame,
    dim_currency: DataFrame,
    dim_source: DataFrame,
) -> DataFrame:
    """One row per asset, date and source: the most recently loaded price, in USD and SAR.

    Equal load times fall back to the later observation, then the higher price.
    """
    return market_prices_of(quoted_prices(stg_equity, stg_metals), fx_to_sar, dim_asset, dim_date, dim_currency, dim_source)


def market_prices_of(
    quotes: DataFrame, fx_to_sar: DataFrame, dim_asset: DataFrame, dim_date: DataFrame, dim_currency: DataFrame, dim_source: DataFrame
) -> DataFrame:
    """The same for any part of the quotes that holds each asset's day whole."""
    rows = asof_join(quotes, fx_to_sar, ["currency_code"], "date", "rate_date", FX_COLUMNS)
    rows = attach(rows, dim_asset, "ticker", "ticker", ["asset_key"], "inner")
    rows = attach(rows, dim_date, "date", "full_date", ["date_key"], "inner")
    rows = attach(rows, dim_currency, "currency_code", "currency_code", ["currency_key"])
    rows = attach(rows, dim_source, "source_name", "source_name", ["source_key"])
    # a ticker has one key and some quotes a day; named beside it, rows dealt by ticker to meet many assets stay there
    latest = latest_by(rows, ["ticker", "asset_key", "date_key", "source_key"], ["loaded_at", "observed_at", "price"])
    return latest.select(
        surrogate_key("asset_key", "date_key", "source_key").alias("market_price_key"),
        "asset_key",
        "date_key",
        "currency_key",
        "source_key",
        "price",
        "exchange_rate",
        "fx_rate_date",
        (F.col("price") * F.col("exchange_rate")).alias("price_sar"),
        "loaded_at",
    )


def daily_positions(holdings: DataFrame) -> DataFrame:
    """Trades of one client, date and asset; quantities are unsigned, a SELL adds."""
    return holdings.groupBy("client_key", "date_key", "asset_key").agg(
        F.sum("quantity").alias("total_quantity"),
        F.sum("value_sar").alias("total_investment"),
        F.sum("fees").alias("total_fees"),
    )


def one_price(market_prices: DataFrame) -> DataFrame:
    """(asset_key, date_key, price_sar, …): of several sources on one date the most recently loaded
    price counts, then the greater source key."""
    return latest_by(
        market_prices.select("asset_key", "date_key", "price_sar", "loaded_at", "source_key"),
        ["asset_key", "date_key"],
        ["loaded_at", "source_key"],
    )


def priced_positions(positions: DataFrame, market_prices: DataFrame, trades: DataFrame | None = None) -> DataFrame:
    """Positions at the latest market price on or before their date, 0 when there is none.

    `trades` may name what the positions were added up from, where that is cheaper to read."""
    take = {"price_sar": "latest_price"}
    # an asset's day has a price for each source at most: which of them counts, as in `one_price`, is decided in the merge
    counts = ["loaded_at", "source_key"]
    priced = asof_join(positions, market_prices, ["asset_key"], "date_key", "date_key", take, tie=counts, probes=trades, few_ties=True)
    return priced.withColumn("price_sar", F.coalesce("latest_price", F.lit(0.0))).drop("latest_price")


def portfolio_values(holdings: DataFrame, market_prices: DataFrame) -> DataFrame:
    """(client_key, date_key, invested, value, fees) of the clients and dates in the holdings."""
    return with_texts(packed_values(packed_trades(holdings), market_prices))


def with_texts(values: DataFrame) -> DataFrame:
    return values.withColumn("client_key", unpacked("client_key"))


def packed_trades(holdings: DataFrame) -> DataFrame:
    """What a portfolio is valued from, with packed keys, in which all its steps are shuffled."""
    client, asset = packed("client_key").alias("client_key"), packed("asset_key").alias("asset_key")
    return pick(holdings, client, "date_key", asset, "quantity", "value_sar", "fees")


def packed_values(trades: DataFrame, market_prices: DataFrame) -> DataFrame:
    """The portfolio values of packed trades, by packed client."""
    market_prices = pick(market_prices, packed("asset_key").alias("asset_key"), "date_key", "price_sar", "loaded_at", "source_key")
    if known_size(trades) is None:
        # they are read twice below, so what is not stored yet is computed once and its lineage cut
        trades = settle(trades)
    # one shuffle serves the positions and the join with their prices; a day of an asset is never much of the whole
    positions = daily_positions(trades.repartition("asset_key", "date_key"))
    positions = priced_positions(positions, market_prices, trades)
    return positions.groupBy("client_key", "date_key").agg(
        F.sum("total_investment").alias("invested"),
        F.sum(F.col("total_quantity").cast("double") * F.col("price_sar")).alias("value"),
        F.sum("total_fees").alias("fees"),
    )


def fact_daily_portfolio_summary(holdings: DataFrame, market_prices: DataFrame) -> DataFrame:
    """One row per client and date: investment, value, fees, return and profit.

    The return compares with the client's previous row, whatever its date. Fees stay in
    transaction currency.
    """
    # a client has at most one row per calendar day here
    history = W.partitionBy("client_key").orderBy(F.col("date_key").asc_nulls_last())
    values = packed_values(packed_trades(holdings), market_prices).withColumn("previous", F.lag("value").over(history))
    return summary_rows(with_texts(values))


def summary_rows(portfolio: DataFrame) -> DataFrame:
    """Rows of the summary from values that know the client's `previous` one."""
    money = "decimal(38,4)"
    return portfolio.select(
        surrogate_key("client_key", "date_key").alias("portfolio_summary_key"),
        "date_key",
        "client_key",
        F.col("invested").cast(money).alias("total_investment"),
        F.col("value").cast(money).alias("portfolio_value_sar"),
        F.col("fees").cast(money).alias("total_fees"),
        relative_change("value", "previous").cast("decimal(38,6)").alias("daily_return"),
        (F.col("value") - F.col("invested")).cast(money).alias("pnl_sar"),
        F.col("value").cast(money).alias("currency_exposure_sar"),
    )
