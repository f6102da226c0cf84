"""Loading, merging and rebuilding through files, as registered queries.

Each run writes to a new folder below the shared folder of the cluster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halala.operators.reshape import stack_rows
from halala.plans.build import build_tables, refresh_after_late_prices, refresh_after_late_rates, refresh_after_ledger_batch
from halala.plans.staging import NOT_A_TICKER, SERIES, stg_equity_prices, stg_ledger_transactions, stg_precious_metals
from halala.schemas import LEDGER_FILE_COLUMNS
from halala.session import scratch_path
from halala.quality.evidence import month_tables, release_report, renew_evidence
from halala.quality.payloads import PayloadError
from halala.sources.landing import batch_id_of, document_files, ledger_deliveries, ledger_files, ledger_rows
from halala.sources.warehouse import Warehouse
from halala.streaming.latest_copy import latest_copy_merge
from halala.streaming.load_once import landed_files, load_feed, load_manifest, loads, raw_rows, stored_violations
from workload.checks import FAILED_GATES_SQL
from workload.galaxy import COMPARABLE, rounded_holdings, rounded_summary
from workload.galaxy_sql import with_blocks
from workload.inputs import (
    Galaxy,
    equity_prices_raw,
    fx_rates_raw,
    ledger_lines,
    ledger_transactions_raw,
    metal_prices_raw,
    table,
)
from workload.registry import ORACLES, register


# ---- load once ------------------------------------------------------------------------------

LOADED_SQL = """
    SELECT ticker, side AS transaction_type, count(*) AS loaded, CAST(sum(quantity) AS DOUBLE) AS quantity
    FROM trade GROUP BY ALL"""


def land_ledger(spark: SparkSession, folder: str, landing: str) -> None:
    lines = ledger_lines(spark, folder).select(*LEDGER_FILE_COLUMNS)
    lines.write.option("header", True).option("escape", '"').csv(landing)


def loaded_per_ticker(raw: DataFrame) -> DataFrame:
    return (
        stg_ledger_transactions(raw)
        .groupBy("ticker", "transaction_type")
        .agg(F.count(F.lit(1)).alias("loaded"), F.sum("quantity").cast("double").alias("quantity"))
    )


@register("ledger_load_once", with_blocks(LOADED_SQL))
def ledger_load_once(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger files through the streaming load; the second run finds nothing new."""
    work = scratch_path(spark)
    land_ledger(spark, folder, f"{work}/landing/internal_ledger")
    for _ in range(2):
        load_feed(spark, ledger_files, f"{work}/landing/internal_ledger", f"{work}/raw", f"{work}/checkpoint")
    return loaded_per_ticker(raw_rows(spark, f"{work}/raw"))


@register("ledger_load_listed", with_blocks(LOADED_SQL))
def ledger_load_listed(spark: SparkSession, folder: str) -> DataFrame:
    """The same files by manifest: first some of them, then all; each is loaded once."""
    work = scratch_path(spark)
    landing = f"{work}/landing/internal_ledger"
    land_ledger(spark, folder, landing)
    manifest = landed_files(spark, landing, "*.csv")
    load_manifest(spark, ledger_files, manifest.where("xxhash64(path) % 2 = 0"), f"{work}/raw")
    load_manifest(spark, ledger_files, manifest, f"{work}/raw")
    return loaded_per_ticker(raw_rows(spark, f"{work}/raw"))


@register("load_stream_then_list", with_blocks(LOADED_SQL))
def load_stream_then_list(spark: SparkSession, folder: str) -> DataFrame:
    """Half of the ledger by stream, then everything by list, then everything by a stream that starts anew."""
    work = scratch_path(spark)
    lines = ledger_lines(spark, folder).select(*LEDGER_FILE_COLUMNS)
    halves = {"a": F.col("client_id") < "C5", "b": ~(F.col("client_id") < "C5")}
    for name, half in halves.items():
        lines.where(half).write.option("header", True).option("escape", '"').csv(f"{work}/{name}/internal_ledger")
    listed = f"{work}/a/internal_ledger", f"{work}/b/internal_ledger"
    load_feed(spark, ledger_files, listed[0], f"{work}/raw", f"{work}/checkpoint")
    load_manifest(spark, ledger_files, landed_files(spark, list(listed), "*.csv"), f"{work}/raw")
    load_feed(spark, ledger_files, listed[1], f"{work}/raw", f"{work}/checkpoint-2")
    return loaded_per_ticker(raw_rows(spark, f"{work}/raw"))


def land_by(spark: SparkSession, folder: str, landing: str, name: str, value: str) -> None:
    """The ledger as one file for each value, in folders `<name>=<value>`."""
    lines = ledger_lines(spark, folder, F.expr(value).alias(name)).select(*LEDGER_FILE_COLUMNS, name)
    # a task has few values, so it keeps their files open instead of sorting its lines by value
    files_at_once = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(files_at_once, None)
    spark.conf.set(files_at_once, "100")
    try:
        lines.repartition(name).write.partitionBy(name).option("header", True).option("escape", '"').csv(landing)
    finally:
        spark.conf.unset(files_at_once) if before is None else spark.conf.set(files_at_once, before)


@register(
    "load_history_rows",
    "SELECT 'shipped=' || strftime(l_shipdate, '%Y%m') AS delivery, count(*) AS row_count FROM lineitem GROUP BY ALL",
)
def load_history_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Rows per loaded file, as the load log has them; a file per month, named here by its folder."""
    work = scratch_path(spark)
    land_by(spark, folder, f"{work}/landing", "shipped", "date_format(l_shipdate, 'yyyyMM')")
    for _ in range(2):
        load_feed(spark, ledger_files, f"{work}/landing", f"{work}/raw", f"{work}/checkpoint")
    return loads(spark, f"{work}/raw").select(F.substring_index("file_name", "/", 1).alias("delivery"), "row_count")


@register(
    "batch_id_of_file",
    "SELECT strftime(l_shipdate, '%Y%m%d') || 'T093000' AS batch_id, count(*) AS lines FROM lineitem GROUP BY ALL",
)
def batch_id_of_file(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger lines per batch, as the stems of their files name it."""
    lines = ledger_transactions_raw(spark, folder).select(batch_id_of(F.col("file_name")).alias("batch_id"))
    return lines.groupBy("batch_id").agg(F.count(F.lit(1)).alias("lines"))


@register(
    "landing_refused",
    """
    SELECT 'line=' || l_linenumber AS delivery, CASE WHEN bad = 0 THEN n ELSE 0 END AS loaded, bad AS violations
    FROM (SELECT l_linenumber, count(*) AS n, count(DISTINCT l_orderkey) FILTER (
              WHERE (l_linenumber = 6 AND l_tax = 0.0) OR (l_linenumber = 7 AND l_suppkey % 50 = 7)) AS bad
          FROM lineitem GROUP BY l_linenumber)""",
)
def landing_refused(spark: SparkSession, folder: str) -> DataFrame:
    """One file per line number, some with violations: those stay outside whole, the others are loaded, and a
    second run repeats neither."""
    work = scratch_path(spark)
    land_by(spark, folder, f"{work}/landing", "line", "l_linenumber")

    def check(rows: DataFrame) -> DataFrame:
        bad = {"not_positive": F.col("price").try_cast("double").isNull(), "client_name_mismatch": F.col("client_name").endswith(" (old)")}
        rules = F.array_compact(F.array(*[F.when(condition, F.lit(rule)) for rule, condition in bad.items()]))
        return rows.select("file_name", F.explode(rules).alias("rule"), F.col("transaction_id").alias("subject"))

    for _ in range(2):
        try:
            load_feed(
                spark, ledger_deliveries, f"{work}/landing", f"{work}/raw", f"{work}/checkpoint",
                check=check, prepare=ledger_rows, keep=f"{work}/violations", name="ledger",
            )
        except PayloadError:
            pass  # what it names is counted below
    delivery = F.substring_index("file_name", "/", 1).alias("delivery")
    loaded = raw_rows(spark, f"{work}/raw").groupBy(delivery).agg(F.count(F.lit(1)).alias("loaded"))
    told = stored_violations(spark, f"{work}/violations").groupBy(delivery).agg(F.count(F.lit(1)).alias("violations"))
    return loaded.join(told, "delivery", "full").fillna(0)


@register(
    "documents_load_once",
    """
    SELECT o_orderpriority AS ticker, CAST(o_orderdate AS DATE) AS date, min(o_totalprice) AS open_price,
           max(o_totalprice) AS high_price, min(o_totalprice) AS low_price, max(o_totalprice) AS close_price,
           count(*) AS volume
    FROM orders GROUP BY ALL""",
)
def documents_load_once(spark: SparkSession, folder: str) -> DataFrame:
    """One JSON file per month with a daily series per priority, loaded twice and staged."""
    daily = (
        table(spark, folder, "orders")
        .groupBy("o_orderpriority", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
        .agg(
            F.min("o_totalprice").cast("decimal(18,2)").cast("string").alias("low"),
            F.max("o_totalprice").cast("decimal(18,2)").cast("string").alias("high"),
            F.count(F.lit(1)).cast("string").alias("n"),
        )
    )
    fields = {"1. open": "low", "2. high": "high", "3. low": "low", "4. close": "high", "5. volume": "n"}
    bar = F.struct(*[F.col(column).alias(name) for name, column in fields.items()])
    # at most 31 days per series and five series per month
    series = F.map_from_entries(F.collect_list(F.struct("day", bar.alias("bar"))))
    by_code = daily.groupBy(F.left("day", F.lit(7)).alias("month"), "o_orderpriority").agg(series.alias("series"))
    months = by_code.groupBy("month").agg(
        F.map_from_entries(F.collect_list(F.struct("o_orderpriority", "series"))).alias("by_code")
    )
    codes = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    meta = F.struct(F.lit("daily").alias("1. Information")).alias(NOT_A_TICKER)
    tickers = [
        F.when(
            F.map_contains_key("by_code", code), F.struct(meta, F.col("by_code")[code].alias(SERIES))
        ).alias(code)
        for code in codes
    ]
    work = scratch_path(spark)
    landing = f"{work}/landing"
    months.select("month", *tickers).repartition("month").write.partitionBy("month").json(landing)
    for _ in range(2):
        load_feed(spark, document_files, landing, f"{work}/raw", f"{work}/checkpoint")
    prices = stg_equity_prices(raw_rows(spark, f"{work}/raw"))
    return prices.drop("file_name", "loaded_at", "source")


# ---- latest copy, in batches ----------------------------------------------------------------


@register(
    "latest_copy_incremental",
    """
    SELECT l_partkey, CAST(l_shipdate AS DATE) AS shipped, l_orderkey, l_linenumber, l_suppkey, l_extendedprice
    FROM lineitem
    QUALIFY row_number() OVER (
        PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
        ORDER BY l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_extendedprice DESC) = 1""",
)
def latest_copy_incremental(spark: SparkSession, folder: str) -> DataFrame:
    """Copies delivered in several files, merged batch by batch into monthly partitions."""
    work = scratch_path(spark)
    day = F.col("l_shipdate").cast("date")
    copies = table(spark, folder, "lineitem").select(
        "l_partkey",
        day.alias("shipped"),
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
        F.date_format(day, "yyyyMM").cast("int").alias("month_key"),
    )
    # two deliveries: odd and even lines; the second is merged with the months it touches
    deliveries = [copies.where("l_linenumber % 2 = 1"), copies.where("l_linenumber % 2 = 0")]
    merge = latest_copy_merge(
        f"{work}/latest",
        f"{work}/slots",
        keys=["l_partkey", "shipped"],
        newest_first=["l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice"],
        partition="month_key",
        checkpoint=f"{work}/checkpoint",
    )
    for delivery in deliveries:
        delivery.write.mode("append").parquet(f"{work}/deliveries")
        stream = spark.readStream.schema(copies.schema).parquet(f"{work}/deliveries")
        query = (
            stream.writeStream.foreachBatch(merge)
            .option("checkpointLocation", f"{work}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.parquet(f"{work}/latest").drop("month_key")


# ---- rebuilds -------------------------------------------------------------------------------


def raw_feeds(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    return {
        "fx_rates_raw": fx_rates_raw(spark, folder),
        "metal_prices_raw": metal_prices_raw(spark, folder),
        "equity_prices_raw": equity_prices_raw(spark, folder),
        "ledger_transactions_raw": ledger_transactions_raw(spark, folder),
    }


# The derived feeds break gates on purpose, and the tables are not offered to SQL.
QUIET = {"gates": False, "publish": False}


def late_rates(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The warehouse built while the rates of 1998 were missing, then refreshed with them."""
    warehouse = Warehouse(spark, scratch_path(spark))
    known = Galaxy(spark, folder).int_fx_rates_to_sar
    early = build_tables(warehouse, raw_feeds(spark, folder), rates_to_sar=known.where(F.year("rate_date") != 1998), **QUIET)
    return refresh_after_late_rates(warehouse, early, known, **QUIET)


@register("late_rate_refresh", ORACLES["fact_holdings"])
def late_rate_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Holdings after late rates."""
    return rounded_holdings(late_rates(spark, folder)["fact_holdings"])


@register("late_rate_summary", ORACLES["fact_daily_portfolio_summary"])
def late_rate_summary(spark: SparkSession, folder: str) -> DataFrame:
    """The daily summary after late rates."""
    return rounded_summary(late_rates(spark, folder)["fact_daily_portfolio_summary"])


@register("late_price_refresh", ORACLES["fact_daily_portfolio_summary"])
def late_price_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The daily summary after prices that came late: metals of a quarter, and one of the two files of some parts."""
    warehouse, raw = Warehouse(spark, scratch_path(spark)), raw_feeds(spark, folder)
    early = raw | {
        "metal_prices_raw": raw["metal_prices_raw"].where("file_name not like 'metal_prices/1996-0%'"),
        "equity_prices_raw": raw["equity_prices_raw"].where("not (file_name like '%7-O.json' or file_name like '%3-F.json')"),
    }
    built = build_tables(warehouse, early, **QUIET)
    equity, metals = stg_equity_prices(raw["equity_prices_raw"]), stg_precious_metals(raw["metal_prices_raw"])
    return rounded_summary(refresh_after_late_prices(warehouse, built, equity, metals, **QUIET)["fact_daily_portfolio_summary"])


def batch_by_batch(spark: SparkSession, folder: str, warehouse: Warehouse | None = None, gated: bool = False) -> dict[str, DataFrame]:
    """The warehouse built without the ledger of two quarters, which then come as two batches; gates may be counted before them."""
    warehouse, raw = warehouse or Warehouse(spark, scratch_path(spark)), raw_feeds(spark, folder)
    ledger = raw["ledger_transactions_raw"]
    late = [F.col("batch_id").startswith("19970"), F.col("batch_id").startswith("19981")]
    now = build_tables(warehouse, raw | {"ledger_transactions_raw": ledger.where(~late[0] & ~late[1])}, **QUIET)
    for name in month_tables() if gated else ():
        renew_evidence(warehouse.release(), name)
    for batch in late:
        now = refresh_after_ledger_batch(warehouse, now, ledger.where(batch), **QUIET)
    return now


@register("ledger_batch_refresh", ORACLES["fact_daily_portfolio_summary"])
def ledger_batch_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """The daily summary after ledger batches."""
    return rounded_summary(batch_by_batch(spark, folder)["fact_daily_portfolio_summary"])


@register("ledger_batch_holdings", ORACLES["fact_holdings"])
def ledger_batch_holdings(spark: SparkSession, folder: str) -> DataFrame:
    """Holdings after ledger batches."""
    return rounded_holdings(batch_by_batch(spark, folder)["fact_holdings"])


@register("failed_gates_by_month", FAILED_GATES_SQL)
def failed_gates_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """The gates that fail after ledger batches, of which only the months that the batches touched are read for them."""
    warehouse = Warehouse(spark, scratch_path(spark))
    now = batch_by_batch(spark, folder, warehouse, gated=True)
    return release_report(warehouse.release(), list(now), now).where("failures > 0")


# Columns of each table whose text is the same in both engines; the others are numbers, in thousandths.
TEXT_COLUMNS = {
    "stg_exchange_rates": ["rate_date", "base_currency", "target_currency", "file_name"],
    "stg_precious_metals": ["base_currency", "file_name"],
    "stg_equity_prices": ["ticker", "date", "volume", "file_name", "source"],
    "stg_ledger_transactions": ["transaction_id", "client_id", "client_name", "portfolio_id", "ticker", "transaction_type", "currency_code", "transaction_date", "batch_id"],
    "int_fx_rates_to_sar": ["rate_date", "currency_code"],
    "dim_asset": ["asset_key", "ticker", "asset_name", "asset_type", "sector"],
    "dim_client": ["client_key", "client_id", "client_name"],
    "dim_currency": ["currency_key", "currency_code"],
    "dim_date": ["date_key", "full_date", "year", "quarter", "month", "day"],
    "dim_source": ["source_key", "source_name", "source_type"],
    "fact_holdings": ["holding_key", "date_key", "asset_key", "client_key", "currency_key", "transaction_type", "fx_rate_date"],
    "fact_market_prices": ["market_price_key", "asset_key", "date_key", "currency_key", "source_key", "fx_rate_date"],
    "fact_daily_portfolio_summary": ["portfolio_summary_key", "date_key", "client_key"],
}
NUMBER_COLUMNS = {
    "stg_exchange_rates": ["exchange_rate"],
    "stg_precious_metals": ["gold_usd", "silver_usd", "platinum_usd", "palladium_usd"],
    "stg_equity_prices": ["open_price", "high_price", "low_price", "close_price"],
    "stg_ledger_transactions": ["quantity", "price", "fees"],
    "fact_holdings": ["quantity", "signed_quantity", "price", "fees", "transaction_value", "value_sar"],
    "fact_market_prices": ["price"],
    "fact_daily_portfolio_summary": ["total_investment", "portfolio_value_sar", "total_fees", "pnl_sar"],
}
DIM_SOURCE_SQL = """
    SELECT md5(source_name) AS source_key, source_name, source_type
    FROM (VALUES ('Internal Ledger', 'Internal'), ('EQUITY_API', 'External'), ('Metal Market Data', 'External')) AS s(source_name, source_type)"""


def digest_sql(name: str) -> str:
    """Rows of a table, and the sum of 60 bits of each row's hash: equal for equal rows in any order."""
    texts = [f"coalesce(CAST({c} AS VARCHAR), '~')" for c in TEXT_COLUMNS[name]]
    texts += [f"coalesce(CAST(CAST(round({c} * 1000) AS BIGINT) AS VARCHAR), '~')" for c in NUMBER_COLUMNS.get(name, [])]
    line = f"CAST('0x' || substr(md5({' || chr(124) || '.join(texts)}), 1, 15) AS BIGINT)"
    source = DIM_SOURCE_SQL if name == "dim_source" else ORACLES[name]
    return f"SELECT '{name}' AS \"table\", count(*) AS rows, CAST(coalesce(sum({line}), 0) AS VARCHAR) AS digest FROM ({source}) AS t"


def digest(name: str, df: DataFrame) -> DataFrame:
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in TEXT_COLUMNS[name]]
    texts += [F.coalesce(F.round(F.col(c) * 1000).cast("bigint").cast("string"), F.lit("~")) for c in NUMBER_COLUMNS.get(name, [])]
    line = F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, 15), 16, 10).cast("decimal(38,0)")
    total = F.coalesce(F.sum(line), F.lit(0)).cast("decimal(38,0)").cast("string")
    return df.agg(F.count(F.lit(1)).alias("rows"), total.alias("digest")).select(F.lit(name).alias("table"), "rows", "digest")


@register("warehouse_build", "\nUNION ALL ".join(digest_sql(name) for name in TEXT_COLUMNS))
def warehouse_build(spark: SparkSession, folder: str) -> DataFrame:
    """A full build, released, and the content of its thirteen tables as they are read back."""
    warehouse = Warehouse(spark, scratch_path(spark))
    build_tables(warehouse, raw_feeds(spark, folder), **QUIET)
    layers = {"stg_": "staging", "int_": "intermediate", "dim_": "analytics", "fac": "analytics"}
    tables = {n: warehouse.read(next(layer for start, layer in layers.items() if n.startswith(start)), n) for n in TEXT_COLUMNS}
    return stack_rows(*(digest(n, COMPARABLE.get(n, lambda df: df)(df)) for n, df in tables.items()))
