"""From landed files to checked tables, in one call."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halala.functions.keys import date_key
from halala.operators.lookup import rows_of
from halala.operators.reshape import stack_rows
from halala.plans import dimensions, facts, fx, staging
from halala.plans.refresh import INTERMEDIATE, LEDGER, refresh_after_late_prices, refresh_after_late_rates, refresh_after_ledger_batch
from halala.quality import payloads
from halala.quality.evidence import enforce_release
from halala.quality.ledger import Book, ledger_violations, row_count_violations
from halala.schemas import DOCUMENT_FEEDS, LEDGER_FEED
from halala.sources.landing import document_files, ledger_deliveries, ledger_rows
from halala.sources.warehouse import ANALYTICS, RAW, STAGING, Warehouse, create_raw_tables, month_of
from halala.streaming.load_once import load_feed, loads, raw_rows, stored_violations

NEVER_CAME = "never_came"

__all__ = ["build_tables", "load_landing", "refresh_after_late_prices", "refresh_after_late_rates", "refresh_after_ledger_batch", "run_all"]


def load_landing(warehouse: Warehouse, landing: str, book: Book | None = None, expected: DataFrame | None = None, rebase: bool = False) -> None:
    """Check what is new in the landing folder and load it into RAW.

    An incomplete or inconsistent file is refused whole, the others are loaded; its violations are kept in the
    table checks/violations, and named in the PayloadError that follows when all feeds are loaded. Ledger
    lines are checked against `book`, and their number per file against `expected` (file_name, rows), where
    these are given; an expected file that never came is a violation too. With `rebase`, rate documents in the
    legacy base are restated to USD before they are stored; else the rates plan does that later.
    """
    spark, keep = warehouse.spark, warehouse.path("checks", "violations")

    def rates(symbols: list[str]):
        return lambda docs: payloads.rate_violations(docs, symbols)

    def lines(rows: DataFrame) -> DataFrame | None:
        found = []
        if expected is not None:
            own = expected.join(rows.select("file_name").distinct(), "file_name", "left_semi")
            counted = row_count_violations(rows, own)
            said = F.concat(F.col("expected").cast("string"), F.lit(" rows expected, found "), F.col("found").cast("string"))
            found.append(counted.select("file_name", F.lit("row_count").alias("rule"), said.alias("subject")))
        if book is not None:
            found.append(ledger_violations(rows, book).select("file_name", "rule", F.col("transaction_id").alias("subject")))
        return stack_rows(*found) if found else None

    create_raw_tables(warehouse)
    checks = {
        "exchange_rates": (rates(payloads.FX_SYMBOLS), fx.rebased_legacy if rebase else None),
        "metal_prices": (rates(payloads.METAL_SYMBOLS), None),
        "equity_prices": (lambda docs: payloads.equity_violations(docs, payloads.EQUITY_TICKERS), None),
    }
    feeds = [(folder, table, document_files, *checks[folder]) for folder, table in DOCUMENT_FEEDS.items()]
    feeds.append((*LEDGER_FEED, ledger_deliveries, lines, ledger_rows))
    refused = []
    for folder, table, read_files, check, prepare in feeds:
        try:
            load_feed(
                spark,
                read_files,
                f"{landing.rstrip('/')}/{folder}",
                warehouse.path(RAW, table),
                warehouse.path("checkpoints", table),
                check=check,
                prepare=prepare,
                keep=keep,
                name=folder,
            )
        except payloads.PayloadError as found:
            refused.append(str(found))
    if expected is not None:
        refused += never_came(warehouse, expected, keep)
    if refused:
        raise payloads.PayloadError("\n".join(refused))


def never_came(warehouse: Warehouse, expected: DataFrame, keep: str) -> list[str]:
    """Record the announced ledger files that are neither loaded nor refused; returns accounts of the first ones."""
    spark, (folder, table) = warehouse.spark, LEDGER_FEED
    known = loads(spark, warehouse.path(RAW, table)).select("file_name")
    told = stored_violations(spark, keep)
    told = told.where(F.col("rule") != NEVER_CAME).select("file_name")
    missing = expected.select("file_name").join(known.unionByName(told).distinct(), "file_name", "left_anti").distinct()
    line = missing.select(F.lit(folder).alias("check"), "file_name", F.lit(NEVER_CAME).alias("rule"), F.lit(None).cast("string").alias("subject"))
    first = line.limit(20).collect()
    if first:
        line.withColumn("found_at", F.current_timestamp()).write.mode("overwrite").parquet(f"{keep}/slot=announced")
    return [f"{r['file_name']} {NEVER_CAME}" for r in first]


def build_tables(
    warehouse: Warehouse, raw: dict[str, DataFrame], gates: bool = True, rates_to_sar: DataFrame | None = None, publish: bool = True
) -> dict[str, DataFrame]:
    """All thirteen tables from the RAW tables; a failed gate stops what comes after it.

    The tables become current together, when all are written and have passed; until then, and after a
    failure, those of the last build are. `rates_to_sar` takes the place of the rates that the staged
    documents give. Staging is written once, so documents are parsed once although several tables read them.
    """
    built: dict[str, DataFrame] = {}
    release = warehouse.release()

    def check(*names: str) -> None:
        if gates:
            enforce_release(release, names, built)

    for name, rows in {
        "stg_exchange_rates": staging.stg_exchange_rates(raw["fx_rates_raw"]),
        "stg_precious_metals": staging.stg_precious_metals(raw["metal_prices_raw"]),
        "stg_equity_prices": staging.stg_equity_prices(raw["equity_prices_raw"]),
    }.items():
        built[name] = release.rebuild(STAGING, name, rows)
    built[LEDGER] = release.rebuild_by_month(
        STAGING,
        LEDGER,
        staging.stg_ledger_transactions(raw["ledger_transactions_raw"]),
        month_of(date_key("transaction_date")),
    )
    check(*built)

    rates, metals = built["stg_exchange_rates"], built["stg_precious_metals"]
    equity, ledger = built["stg_equity_prices"], built[LEDGER]

    to_sar = fx.int_fx_rates_to_sar(rates) if rates_to_sar is None else rates_to_sar
    sar = release.rebuild(INTERMEDIATE, "int_fx_rates_to_sar", to_sar)
    built["int_fx_rates_to_sar"] = sar
    for name, rows in {
        "dim_asset": dimensions.dim_asset(equity, ledger),
        "dim_client": dimensions.dim_client(ledger),
        "dim_currency": dimensions.dim_currency(ledger, rates, sar),
        "dim_date": dimensions.dim_date(ledger, equity, metals, rates),
        "dim_source": dimensions.dim_source(warehouse.spark),
    }.items():
        built[name] = release.rebuild(ANALYTICS, name, rows)
    dims = [name for name in built if name.startswith("dim_")]
    check("int_fx_rates_to_sar", *dims)

    asset, day, currency = built["dim_asset"], built["dim_date"], built["dim_currency"]
    holdings = facts.fact_holdings(ledger, sar, day, asset, built["dim_client"], currency)
    built["fact_holdings"] = release.rebuild_by_month(
        ANALYTICS, "fact_holdings", holdings, month_of("date_key"), rows_of(ledger)
    )
    prices = facts.fact_market_prices(equity, metals, sar, asset, day, currency, built["dim_source"])
    built["fact_market_prices"] = release.rebuild_by_month(ANALYTICS, "fact_market_prices", prices, month_of("date_key"), rows_of(equity, metals))
    check("fact_holdings", "fact_market_prices")

    summary = facts.fact_daily_portfolio_summary(built["fact_holdings"], built["fact_market_prices"])
    built["fact_daily_portfolio_summary"] = release.rebuild_by_month(
        ANALYTICS, "fact_daily_portfolio_summary", summary, month_of("date_key"), rows_of(built["fact_holdings"])
    )
    check("fact_daily_portfolio_summary")

    release.commit()
    if publish:
        for layer, prefixes in {STAGING: ("stg_",), ANALYTICS: ("dim_", "fact_")}.items():
            warehouse.publish(layer, *(n for n in built if n.startswith(prefixes)))
    return built


def run_all(
    spark: SparkSession,
    landing: str,
    root: str,
    gates: bool = True,
    book: Book | None = None,
    expected: DataFrame | None = None,
    rebase: bool = False,
) -> dict[str, DataFrame]:
    """Check and load the landing folder, and rebuild every table under `root`."""
    warehouse = Warehouse(spark, root)
    load_landing(warehouse, landing, book, expected, rebase)
    tables = [*DOCUMENT_FEEDS.values(), LEDGER_FEED[1]]
    return build_tables(warehouse, {t: raw_rows(spark, warehouse.path(RAW, t)) for t in tables}, gates)
