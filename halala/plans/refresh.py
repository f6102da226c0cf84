"""Late rates, late prices and new ledger batches, carried through to the summary without a rebuild.

Each refresh finds what changed, from the change to the client days it reaches, and writes the months it
touches; they become current together, in one release. Deliveries add rows or correct them, so nothing has
to disappear.

* A **rate** changes the transactions whose as-of answer differs, and the quotes likewise.
* A **price** changes the positions of its asset from its day to the asset's next price.
* A **ledger batch** adds its rows; a client's further name touches all months of that client.

A client's day that changes also changes the return of the client's following day, whatever its month.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from halala.functions.keys import date_key, hashed, packed, unpacked
from halala.operators.asof import asof_join
from halala.operators.lookup import checked_broadcast, settle
from halala.operators.reshape import stack_rows
from halala.plans import dimensions, facts, staging
from halala.quality.evidence import enforce_release
from halala.sources.warehouse import ANALYTICS, MONTH, STAGING, Release, Warehouse, month_folder, month_of
from halala.streaming.late_rates import changed_months, changed_probes

INTERMEDIATE = "intermediate"
LEDGER, HOLDINGS, PRICES, SUMMARY = "stg_ledger_transactions", "fact_holdings", "fact_market_prices", "fact_daily_portfolio_summary"
DIMENSIONS = ["dim_date", "dim_asset", "dim_client", "dim_currency"]

# Rows without a client or day are a group of their own, after all others, as in the facts.
_DAY, _DAYS = "coalesce(date_key, 99999999)", ["_client", "_day"]


def _with_days(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"_client": packed(F.coalesce("client_key", F.lit(""))), "_day": F.expr(_DAY)})


def _others(stored: DataFrame, given: DataFrame, keys: list[str]) -> DataFrame:
    """Stored rows whose keys are not among the given ones; their texts that end in _key are moved packed."""

    def moved(rows: DataFrame) -> DataFrame:
        texts = [c for c, kind in rows.dtypes if kind == "string" and c.endswith("_key")]
        return rows.withColumns({c: packed(c) for c in texts})

    left = moved(stored).join(moved(given.select(*keys)), keys, "left_anti")
    return left.select(*[unpacked(c).alias(c) if kind == "string" and c.endswith("_key") else c for c, kind in stored.dtypes])


def _days(rows: DataFrame) -> DataFrame:
    return _with_days(rows).select(*_DAYS).distinct()


def _months(days: DataFrame) -> DataFrame:
    """Months of the days; the group without a day has month NULL."""
    known = F.when(F.col("_day") < 99999999, month_of("_day"))
    return days.select(known.alias(MONTH)).distinct()


def _folders(months: DataFrame) -> list[str]:
    return [month_folder(r[MONTH]) for r in months.distinct().collect()]


def _of_months(release: Release, layer: str, table: str, months: DataFrame | list[str]) -> DataFrame:
    """Rows of some months, as they will be after the release; their columns only."""
    named = months if isinstance(months, list) else _folders(months)
    return release.warehouse.frame(layer, table, release.state(layer, table), named)


def changed_quotes(before: DataFrame, after: DataFrame) -> DataFrame:
    """(ticker, date) of the quotes that only one of two states has, or has more often."""
    signed = stack_rows(after.withColumn("_n", F.lit(1)), before.withColumn("_n", F.lit(-1)))
    # quotes of a day meet once, for the comparison and for the days
    counted = signed.where("ticker is not null and date is not null").repartition("ticker", "date").groupBy(*after.columns)
    return counted.agg(F.sum("_n").alias("_n")).where("_n <> 0").select("ticker", "date").distinct()


def changed_prices(old: DataFrame, new: DataFrame) -> DataFrame:
    """(asset_key, date_key, changed) for every priced day of the assets with a change, in either state."""
    key = ["asset_key", "date_key"]

    def named(prices: DataFrame, name: str) -> DataFrame:
        return facts.one_price(prices).select(*key, F.struct("price_sar").alias(name))

    both = named(old, "before").join(named(new, "after"), key, "full").where("asset_key is not null")
    marked = both.select(*key, (~F.col("before").eqNullSafe(F.col("after"))).alias("changed"))
    # over the asset's days, so that the two states are compared once
    any_day = F.max("changed").over(W.partitionBy("asset_key"))
    return marked.withColumn("_any", any_day).where("_any").drop("_any")


def repriced_days(holdings: DataFrame, marked: DataFrame) -> DataFrame:
    """Client days with a position whose latest price on or before the day is a changed one."""
    assets = checked_broadcast(marked.select("asset_key").distinct())
    asked = settle(holdings.select("asset_key", "date_key").distinct().join(assets, "asset_key", "left_semi"))
    held = holdings.select("client_key", "date_key", "asset_key")
    flagged = asof_join(held, marked, ["asset_key"], "date_key", "date_key", {"changed": "changed"}, probes=asked)
    return _days(flagged.where("changed"))


def _refresh_summary(release: Release, prices: DataFrame, days: DataFrame) -> DataFrame:
    """Compute the given client days and the ones that follow them, and write their months."""
    days = settle(days)
    clients = checked_broadcast(days.select("_client").distinct())
    # a row for each client day that was there, and the given ones: one shuffle by client serves all steps
    stored = _with_days(release.frame(ANALYTICS, SUMMARY).select("client_key", "date_key")).select(*_DAYS)
    known = stored.join(clients, "_client", "left_semi").withColumn("_hit", F.lit(None).cast("boolean"))
    both = known.unionByName(days.select(*_DAYS, F.lit(True).alias("_hit"))).repartition("_client")
    calendar = both.groupBy(*_DAYS).agg(F.max("_hit").alias("_hit"))
    history = W.partitionBy("_client").orderBy("_day")
    marked = calendar.withColumns({"_before": F.lag("_day").over(history), "_hit_before": F.lag("_hit").over(history)})
    touched = settle(marked.where("_hit or _hit_before").select(*_DAYS, "_before"))

    needed = stack_rows(touched.select(*_DAYS), touched.where("_before is not null").select("_client", F.col("_before").alias("_day"))).distinct()
    trades = facts.packed_trades(_of_months(release, ANALYTICS, HOLDINGS, _months(needed)))
    trades = trades.withColumns({"_client": F.coalesce("client_key", F.lit(b"")), "_day": F.expr(_DAY)})
    rows = trades.join(needed, _DAYS, "left_semi").drop(*_DAYS)
    values = settle(_with_days(facts.with_texts(facts.packed_values(rows, prices))))
    previous = values.select("_client", F.col("_day").alias("_before"), F.col("value").alias("previous"))
    lines = facts.summary_rows(values.join(touched, _DAYS).join(previous, ["_client", "_before"], "left"))

    months = _folders(_months(touched))
    stored = _with_days(_of_months(release, ANALYTICS, SUMMARY, months))
    others = _others(stored, touched, _DAYS).drop(*_DAYS)
    about = release.about(ANALYTICS, SUMMARY, len(months))
    return release.replace_months(ANALYTICS, SUMMARY, others.unionByName(lines), month_of("date_key"), about)


def _refresh_prices(release: Release, now: dict[str, DataFrame], changed: DataFrame) -> DataFrame:
    """Compute the quotes of the given (ticker, date) pairs anew and write their months."""
    quotes = facts.quoted_prices(now["stg_equity_prices"], now["stg_precious_metals"])
    fresh = quotes.join(checked_broadcast(changed), ["ticker", "date"], "left_semi")
    lines = settle(facts.market_prices_of(fresh, now["int_fx_rates_to_sar"], *(now[d] for d in ("dim_asset", "dim_date", "dim_currency", "dim_source"))))
    months = _folders(changed.select(month_of(date_key("date")).alias(MONTH)))
    stored = _of_months(release, ANALYTICS, PRICES, months)
    keys = ["asset_key", "date_key", "source_key"]
    others = _others(stored, lines, keys)
    about = release.about(ANALYTICS, PRICES, len(months))
    return release.replace_months(ANALYTICS, PRICES, others.unionByName(lines), month_of("date_key"), about)


def _finish(release: Release, now: dict[str, DataFrame], touched: list[str], gates: bool, publish: bool) -> dict[str, DataFrame]:
    if gates:
        enforce_release(release, touched, now)
    layers = {(e["layer"], e["name"]) for e in release.entries}
    release.commit()
    if publish:
        for layer, name in sorted(layers):
            if layer != INTERMEDIATE:
                release.warehouse.publish(layer, name)
    return now


def refresh_after_late_rates(
    warehouse: Warehouse, built: dict[str, DataFrame], new_rates: DataFrame, gates: bool = True, publish: bool = True
) -> dict[str, DataFrame]:
    """Carry late or corrected rates through to the summary, and check the facts again.

    `built` are the tables of the last build, `new_rates` the rates to SAR as they are now.
    """
    release, now = warehouse.release(), dict(built)
    now["int_fx_rates_to_sar"] = rates = release.rebuild(INTERMEDIATE, "int_fx_rates_to_sar", new_rates)
    changed = settle(changed_probes(built[LEDGER], built["int_fx_rates_to_sar"], rates))
    months = settle(changed_months(changed))
    folders = _folders(months)
    revalued = facts.fact_holdings(_of_months(release, STAGING, LEDGER, folders), rates, *(now[d] for d in DIMENSIONS))
    now[HOLDINGS] = release.replace_months(ANALYTICS, HOLDINGS, revalued, month_of("date_key"), release.about(STAGING, LEDGER, len(folders)))
    codes = now["dim_currency"].select("currency_code", "currency_key")
    hit = changed.join(checked_broadcast(codes), "currency_code").select("currency_key", date_key("transaction_date").alias("date_key")).distinct()
    days = _days(_of_months(release, ANALYTICS, HOLDINGS, folders).join(hit, ["currency_key", "date_key"], "left_semi"))

    quotes = facts.quoted_prices(now["stg_equity_prices"], now["stg_precious_metals"])
    quoted = quotes.select("ticker", F.col("date").alias("transaction_date"), "currency_code")
    moved = changed_probes(quoted, built["int_fx_rates_to_sar"], rates)
    dated = moved.select(F.col("transaction_date").alias("date")).distinct()
    requoted = settle(quotes.join(checked_broadcast(dated), "date", "left_semi").select("ticker", "date").distinct())
    if not requoted.isEmpty():
        now[PRICES] = _refresh_prices(release, now, requoted)
        days = days.unionByName(repriced_days(now[HOLDINGS], settle(changed_prices(built[PRICES], now[PRICES])))).distinct()
    now[SUMMARY] = _refresh_summary(release, now[PRICES], days)
    return _finish(release, now, ["int_fx_rates_to_sar", HOLDINGS, PRICES, SUMMARY], gates, publish)


def _grown(release: Release, now: dict[str, DataFrame], name: str, rows: DataFrame, key: list[str]) -> DataFrame:
    """The dimension with those of `rows` whose key it lacks; written only when there are any."""
    more = settle(rows.join(now[name].select(*key), key, "left_anti"))
    if not more.isEmpty():
        now[name] = release.rebuild(ANALYTICS, name, now[name].unionByName(more))
    return more


def refresh_after_late_prices(
    warehouse: Warehouse, built: dict[str, DataFrame], stg_equity: DataFrame, stg_metals: DataFrame, gates: bool = True, publish: bool = True
) -> dict[str, DataFrame]:
    """Carry late or corrected prices through to the summary; the staged prices are given as they are now."""
    release, now = warehouse.release(), dict(built)
    now["stg_equity_prices"] = release.rebuild(STAGING, "stg_equity_prices", stg_equity)
    now["stg_precious_metals"] = release.rebuild(STAGING, "stg_precious_metals", stg_metals)
    before, after = (facts.quoted_prices(x["stg_equity_prices"], x["stg_precious_metals"]) for x in (built, now))
    changed = settle(changed_quotes(before, after))

    nothing = built[LEDGER].where("false")
    _grown(release, now, "dim_asset", dimensions.dim_asset(now["stg_equity_prices"], nothing), ["ticker"])
    days = dimensions.dim_date(nothing, now["stg_equity_prices"], now["stg_precious_metals"], built["stg_exchange_rates"].where("false"))
    _grown(release, now, "dim_date", days, ["date_key"])
    if not changed.isEmpty():
        now[PRICES] = _refresh_prices(release, now, changed)
        reached = repriced_days(now[HOLDINGS], settle(changed_prices(built[PRICES], now[PRICES])))
        now[SUMMARY] = _refresh_summary(release, now[PRICES], reached)
    return _finish(release, now, ["stg_equity_prices", "stg_precious_metals", "dim_asset", "dim_date", PRICES, SUMMARY], gates, publish)


def refresh_after_ledger_batch(
    warehouse: Warehouse, built: dict[str, DataFrame], batch: DataFrame, gates: bool = True, publish: bool = True
) -> dict[str, DataFrame]:
    """Add the RAW ledger rows of one loaded batch, up to the summary.

    Months of the ledger and the holdings that the batch has no row in are not read, unless a client of
    the batch came with a further name.
    """
    release, now = warehouse.release(), dict(built)
    added = settle(staging.stg_ledger_transactions(batch))
    month = month_of(date_key("transaction_date"))
    months = added.select(month.alias(MONTH)).distinct()
    stored = _of_months(release, STAGING, LEDGER, months)
    now[LEDGER] = release.replace_months(STAGING, LEDGER, stored.unionByName(added), month)

    rates = now["int_fx_rates_to_sar"]
    no_equity, no_metals, no_rates = (built[n].where("false") for n in ("stg_equity_prices", "stg_precious_metals", "stg_exchange_rates"))
    known_clients = built["dim_client"].select("client_id").distinct()
    _grown(release, now, "dim_asset", dimensions.dim_asset(no_equity, added), ["ticker"])
    _grown(release, now, "dim_date", dimensions.dim_date(added, no_equity, no_metals, no_rates), ["date_key"])
    _grown(release, now, "dim_currency", dimensions.dim_currency(added, no_rates, rates.where("false")), ["currency_code"])
    renamed = _grown(release, now, "dim_client", dimensions.dim_client(added), ["client_id", "client_name"]).join(known_clients, "client_id", "left_semi")
    renamed = settle(renamed.select("client_id", "client_key").distinct())

    days = added.select(date_key("transaction_date").alias("date_key"), F.when(F.col("client_id").isNotNull(), hashed("client_id")).alias("client_key"))
    if not renamed.isEmpty():
        others = now[LEDGER].join(checked_broadcast(renamed.select("client_id")), "client_id", "left_semi")
        months = months.unionByName(others.select(month.alias(MONTH))).distinct()
        days = days.unionByName(others.select(date_key("transaction_date").alias("date_key"), hashed("client_id").alias("client_key")))
    folders = _folders(months)
    lines = facts.fact_holdings(_of_months(release, STAGING, LEDGER, folders), rates, *(now[d] for d in DIMENSIONS))
    now[HOLDINGS] = release.replace_months(ANALYTICS, HOLDINGS, lines, month_of("date_key"), release.about(STAGING, LEDGER, len(folders)))
    now[SUMMARY] = _refresh_summary(release, now[PRICES], _days(days))
    return _finish(release, now, [LEDGER, *DIMENSIONS, HOLDINGS, SUMMARY], gates, publish)

