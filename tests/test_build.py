"""Landing folder to checked tables, and incremental refreshes against full rebuilds."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from halala.operators.pick import latest_by
from halala.plans.build import (
    build_tables,
    load_landing,
    refresh_after_late_prices,
    refresh_after_late_rates,
    refresh_after_ledger_batch,
    run_all,
)
from halala.quality.gates import GateFailure
from halala.quality.payloads import PayloadError
from halala.sources.warehouse import ANALYTICS, MONTH, Warehouse, month_of
from halala.streaming.late_rates import changed_probes
from halala.streaming.latest_copy import latest_copy_merge
from halala.streaming.load_once import raw_rows
from tests.fixtures import DAY0, bar, book, equities, land_two_weeks, ledger_row, metals, raw_ledger, write_ledger, write_text


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    work = tmp_path_factory.mktemp("run")
    land_two_weeks(f"{work}/landing")
    return work, run_all(spark, f"{work}/landing", f"{work}/warehouse")


def test_row_counts_of_two_weeks(built):
    """The counts a delivery of this shape must give; all gates have passed by then."""
    _, tables = built
    assert {name: df.count() for name, df in tables.items()} == {
        "stg_exchange_rates": 56,
        "stg_precious_metals": 14,
        "stg_equity_prices": 80,
        "stg_ledger_transactions": 1000,
        "int_fx_rates_to_sar": 57,
        "dim_asset": 12,
        "dim_client": 20,
        "dim_currency": 5,
        "dim_date": 14,
        "dim_source": 3,
        "fact_holdings": 1000,
        "fact_market_prices": 136,
        "fact_daily_portfolio_summary": 100,
    }


def test_eur_day_is_rebased(built):
    _, tables = built
    rates = {r.currency_code: r.rate_to_sar for r in tables["int_fx_rates_to_sar"].where(F.col("rate_date") == DAY0).collect()}
    assert rates["EUR"] == pytest.approx(4.35)
    assert rates["USD"] == pytest.approx(4.35 / 1.16)
    assert rates["SAR"] == 1.0


def test_refused_deliveries_stay_outside(spark, tmp_path, rows):
    """Every violation is kept, the batch is not loaded, and a corrected delivery is."""
    land_two_weeks(f"{tmp_path}/landing", rows_per_batch=3)
    ledger = f"{tmp_path}/landing/internal_ledger"
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    load_landing(warehouse, f"{tmp_path}/landing", book(spark))
    assert warehouse.read("raw", "ledger_transactions_raw").count() == 15
    write_ledger(f"{ledger}/20260320T090000.csv", [ledger_row(n, DAY0, currency="EUR") for n in range(30)])
    with pytest.raises(PayloadError, match="currency_mismatch"):
        load_landing(warehouse, f"{tmp_path}/landing", book(spark))
    assert warehouse.read("raw", "ledger_transactions_raw").count() == 15
    kept = warehouse.read("checks", "violations")
    assert rows(kept.groupBy("check", "file_name", "rule").count()) == [
        ("internal_ledger", "internal_ledger/20260320T090000.csv", "currency_mismatch", 30)
    ]
    other = Warehouse(spark, f"{tmp_path}/other")
    expected = spark.createDataFrame([("internal_ledger/20260320T090000.csv", 31)], "file_name string, rows bigint")
    with pytest.raises(PayloadError, match="31 rows expected, found 30"):
        load_landing(other, f"{tmp_path}/landing", expected=expected)


def test_incomplete_documents_are_refused(spark, tmp_path, rows):
    """The bad file stays outside, the good ones of its batch are loaded, and a corrected delivery is."""
    land_two_weeks(f"{tmp_path}/landing", rows_per_batch=3)
    bad = f"{tmp_path}/landing/metal_prices/2026-03-20.json"
    write_text(bad, metals(DAY0, XAU=4000))
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    with pytest.raises(PayloadError, match="missing_or_invalid_rate"):
        load_landing(warehouse, f"{tmp_path}/landing")
    for _ in range(2):
        assert warehouse.read("raw", "metal_prices_raw").count() == 14
        assert warehouse.read("raw", "ledger_transactions_raw").count() == 15
        assert warehouse.read("checks", "violations").select("check", "subject").count() == 3
        load_landing(warehouse, f"{tmp_path}/landing")
    write_text(bad, metals(DAY0, XAU=4000, XAG=60.5, XPT=1700.25, XPD=1300.125))
    later = (dt.datetime.now() + dt.timedelta(seconds=5)).timestamp()
    os.utime(bad, (later, later))
    for _ in range(2):
        load_landing(warehouse, f"{tmp_path}/landing")
        assert warehouse.read("raw", "metal_prices_raw").count() == 15
    names = raw_rows(spark, warehouse.path("raw", "metal_prices_raw")).select("file_name")
    assert names.count() == names.distinct().count() == 15


def test_an_announced_file_that_never_came_is_reported(spark, tmp_path, rows):
    land_two_weeks(f"{tmp_path}/landing", rows_per_batch=3)
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    names = [("internal_ledger/20260302T090000.csv", 3), ("internal_ledger/20260401T090000.csv", 7)]
    expected = spark.createDataFrame(names, "file_name string, rows bigint")
    for _ in range(2):
        with pytest.raises(PayloadError, match="20260401T090000.csv never_came"):
            load_landing(warehouse, f"{tmp_path}/landing", expected=expected)
        assert rows(warehouse.read("checks", "violations"), "file_name", "rule") == [(names[1][0], "never_came")]
    assert warehouse.read("raw", "ledger_transactions_raw").count() == 15


def test_legacy_rates_are_restated_at_ingest(spark, tmp_path, rows):
    land_two_weeks(f"{tmp_path}/landing", rows_per_batch=3)
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    load_landing(warehouse, f"{tmp_path}/landing", rebase=True)
    bases = warehouse.read("raw", "fx_rates_raw").select(F.get_json_object("raw", "$.base").alias("base"))
    assert rows(bases.groupBy("base").count()) == [("USD", 14)]


def test_build_with_empty_feeds(spark, tmp_path):
    for folder in ("exchange_rates", "metal_prices", "equity_prices", "internal_ledger"):
        (tmp_path / "landing" / folder).mkdir(parents=True)
    built = run_all(spark, f"{tmp_path}/landing", f"{tmp_path}/warehouse", gates=False)
    assert {n: df.count() for n, df in built.items() if n.startswith(("stg_", "fact_"))} == dict.fromkeys(
        [n for n in built if n.startswith(("stg_", "fact_"))], 0
    )


def test_views_are_published(spark, built):
    assert spark.sql("select * from analytics_fact_daily_portfolio_summary limit 10").count() == 10
    assert "month_key" not in spark.table("analytics_fact_holdings").columns


def test_tables_of_two_warehouses_do_not_hide_each_other(spark, built, tmp_path):
    work, tables = built
    assert spark.sql("select * from analytics.fact_daily_portfolio_summary limit 10").count() == 10
    land_two_weeks(f"{tmp_path}/landing", rows_per_batch=3)
    run_all(spark, f"{tmp_path}/landing", f"{tmp_path}/warehouse")
    first, second = Warehouse(spark, f"{work}/warehouse"), Warehouse(spark, f"{tmp_path}/warehouse")
    assert first.schema(ANALYTICS) == "analytics" != second.schema(ANALYTICS)
    assert spark.sql("select * from analytics.fact_holdings").count() == 1000
    assert spark.sql(f"select * from {second.schema(ANALYTICS)}.fact_holdings").count() == 15
    assert spark.sql("select * from staging.stg_equity_prices").columns == tables["stg_equity_prices"].columns
    assert spark.sql("select * from analytics.fact_holdings").columns == tables["fact_holdings"].columns


def test_a_dead_build_leaves_the_tables_as_they_were(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path))
    first = spark.createDataFrame([(20260115, "a"), (20260215, "b"), (None, "c")], "date_key int, v string")
    warehouse.rebuild(ANALYTICS, "d", first)
    old = warehouse.rebuild_by_month(ANALYTICS, "f", first, month_of("date_key"))
    second = spark.createDataFrame([(20260115, "z")], first.schema)
    with pytest.raises(RuntimeError), warehouse.release() as release:
        assert rows(release.rebuild(ANALYTICS, "d", second)) == rows(second)
        release.replace_months(ANALYTICS, "f", second, month_of("date_key"))
        assert rows(release.frame(ANALYTICS, "f")) == rows(stacked(second, first.where("v <> 'a'")))
        raise RuntimeError("killed")
    for name in ("d", "f"):
        assert rows(warehouse.read(ANALYTICS, name)) == rows(first)
    with warehouse.release() as release:
        release.rebuild(ANALYTICS, "d", second)
        release.rebuild_by_month(ANALYTICS, "f", second, month_of("date_key"))
        assert rows(warehouse.read(ANALYTICS, "d")) == rows(first)
    for name in ("d", "f"):
        assert rows(warehouse.read(ANALYTICS, name)) == rows(second)
    assert rows(old) == rows(first)
    assert len(warehouse.drop_old_versions()) == 4  # two old ones, two of the dead build
    assert rows(warehouse.read(ANALYTICS, "f")) == rows(second)


def test_an_empty_table_by_month(spark, tmp_path, rows):
    warehouse = Warehouse(spark, f"{tmp_path}/w")
    empty = spark.createDataFrame([], "date_key int, v string")
    warehouse.rebuild_by_month("empties", "f", empty, month_of("date_key"))
    assert rows(warehouse.read("empties", "f")) == [] and warehouse.read("empties", "f").columns == empty.columns
    assert warehouse.publish("empties", "f") == {"f": "empties.f"}
    assert rows(spark.table("empties.f")) == []


def stacked(*frames):
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def test_a_failed_gate_stops_the_build(spark, tmp_path):
    land_two_weeks(f"{tmp_path}/landing", rows_per_batch=5)
    bad = [ledger_row(900, DAY0, client_id="H-02", client_name="Somebody else")]
    write_ledger(f"{tmp_path}/landing/internal_ledger/20260320T090000.csv", bad)
    with pytest.raises(GateFailure, match=r"dim_client: unique\(client_id\)"):
        run_all(spark, f"{tmp_path}/landing", f"{tmp_path}/warehouse")
    warehouse = Warehouse(spark, f"{tmp_path}/warehouse")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        warehouse.read(ANALYTICS, "fact_holdings")


def test_late_rate_refresh_equals_full_rebuild(spark, built, tmp_path, rows):
    work, tables = built
    raw = {
        name: spark.read.parquet(f"{work}/warehouse/raw/{name}")
        for name in ["fx_rates_raw", "metal_prices_raw", "equity_prices_raw", "ledger_transactions_raw"]
    }
    late = raw | {"fx_rates_raw": raw["fx_rates_raw"].where("file_name not like '%2026-03-08%'")}
    warehouse = Warehouse(spark, f"{tmp_path}/w")
    old = build_tables(warehouse, late)
    changed = changed_probes(old["stg_ledger_transactions"], old["int_fx_rates_to_sar"], tables["int_fx_rates_to_sar"])
    assert rows(changed) == [("USD", dt.date(2026, 3, 8))]
    assert rows(old["fact_holdings"]) != rows(tables["fact_holdings"])
    now = refresh_after_late_rates(warehouse, old, tables["int_fx_rates_to_sar"])
    for name in ["int_fx_rates_to_sar", "fact_holdings", "fact_market_prices", "fact_daily_portfolio_summary"]:
        layer = "intermediate" if name.startswith("int_") else ANALYTICS
        assert rows(warehouse.read(layer, name), *tables[name].columns) == rows(tables[name]), name
        assert rows(now[name], *tables[name].columns) == rows(tables[name]), name


RAW_TABLES = ["fx_rates_raw", "metal_prices_raw", "equity_prices_raw", "ledger_transactions_raw"]
FACTS = ["fact_holdings", "fact_market_prices", "fact_daily_portfolio_summary"]


def month_folders(work, table):
    return {str(p) for p in work.glob(f"analytics/{table}/table_version=*/month_key=*")}


def test_late_price_refresh_equals_full_rebuild(spark, built, tmp_path, rows):
    """A corrected close, a new ticker's series and a metal quote that comes late reach the client days behind them."""
    work, _ = built
    raw = {name: spark.read.parquet(f"{work}/warehouse/raw/{name}") for name in RAW_TABLES}
    text = equities({"SPY": {"2026-03-10": bar(500), "2026-03-11": bar(600), "2026-05-04": bar(7)}, "NEW": {"2026-03-03": bar(1)}})
    late = spark.createDataFrame([(text, "equity_prices/late.json", dt.datetime(2030, 1, 1))], "raw string, file_name string, loaded_at timestamp")
    more = {"equity_prices_raw": raw["equity_prices_raw"].drop("load_batch").unionByName(late)}
    warehouse = Warehouse(spark, f"{tmp_path}/w")
    old = build_tables(warehouse, raw | {"metal_prices_raw": raw["metal_prices_raw"].where("file_name not like '%2026-03-09%'")}, publish=False)
    full = build_tables(Warehouse(spark, f"{tmp_path}/full"), raw | more, publish=False)
    now = refresh_after_late_prices(warehouse, old, full["stg_equity_prices"], full["stg_precious_metals"], publish=False)
    assert rows(old["fact_daily_portfolio_summary"]) != rows(full["fact_daily_portfolio_summary"])
    for name in ["dim_asset", "dim_date", *FACTS]:
        assert rows(now[name], *full[name].columns) == rows(full[name]), name
        assert rows(warehouse.read(ANALYTICS, name)) == rows(full[name]), name


def test_ledger_batch_refresh_equals_full_rebuild(spark, built, tmp_path, rows):
    """A batch with a new client, ticker and currency, an earlier month, no day, and a client's further name."""
    work, _ = built
    raw = {name: spark.read.parquet(f"{work}/warehouse/raw/{name}").drop("load_batch") for name in RAW_TABLES}
    warehouse = Warehouse(spark, f"{tmp_path}/w")
    old = build_tables(warehouse, raw, gates=False, publish=False)
    lines = [
        ledger_row(901, dt.date(2026, 4, 7), client_id="new", client_name="New"), ledger_row(902, DAY0, ticker="ZZZ", currency="KWD"),
        ledger_row(903, dt.date(2026, 2, 3)), ledger_row(904, dt.date(2026, 3, 5)), ledger_row(905, "unknown"), ledger_row(906, dt.date(2026, 4, 8)),
    ]
    batch = raw_ledger(spark, lines, "internal_ledger/late.csv")
    for step, more in enumerate([batch, raw_ledger(spark, [ledger_row(907, dt.date(2026, 4, 9), client_name="Another")], "internal_ledger/later.csv")]):
        raw = raw | {"ledger_transactions_raw": raw["ledger_transactions_raw"].unionByName(more)}
        before = month_folders(tmp_path / "w", "fact_holdings")
        old = refresh_after_ledger_batch(warehouse, old, more, gates=False, publish=False)
        full = build_tables(Warehouse(spark, f"{tmp_path}/full{step}"), raw, gates=False, publish=False)
        for name in ["dim_asset", "dim_client", "dim_currency", "dim_date", *FACTS]:
            assert rows(old[name], *full[name].columns) == rows(full[name]), (step, name)
        written = {p.split("=")[-1] for p in month_folders(tmp_path / "w", "fact_holdings") - before}
        assert ("202603" in written) and ("202604" in written)
    quiet = raw_ledger(spark, [ledger_row(908, dt.date(2026, 6, 9))], "internal_ledger/last.csv")
    before = month_folders(tmp_path / "w", "fact_holdings"), month_folders(tmp_path / "w", "fact_daily_portfolio_summary")
    refresh_after_ledger_batch(warehouse, old, quiet, gates=False, publish=False)
    for table, known in zip(["fact_holdings", "fact_daily_portfolio_summary"], before, strict=True):
        assert {p.split("=")[-1] for p in month_folders(tmp_path / "w", table) - known} == {"202606"}


def test_only_differing_months_are_rewritten(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path))
    first = spark.createDataFrame([(20260115, "a"), (20260116, "b"), (20260215, "c")], "date_key int, v string")
    warehouse.rebuild_by_month("analytics", "f", first, month_of("date_key"))
    second = spark.createDataFrame([(20260115, "x"), (20260116, "b"), (20260215, "c"), (20260315, "new")], first.schema)
    assert warehouse.replace_changed_months("analytics", "f", second, month_of("date_key")) == [202601, 202603]
    assert rows(warehouse.read("analytics", "f")) == rows(second)
    assert warehouse.replace_changed_months("analytics", "f", second, month_of("date_key")) == []


def test_refresh_rewrites_touched_months_only(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path))
    first = spark.createDataFrame([(20260115, "a"), (20260116, "b"), (20260215, "c")], "date_key int, v string")
    warehouse.rebuild_by_month("analytics", "f", first, month_of("date_key"))
    february = sorted(p.name for p in (tmp_path / "analytics/f").glob("table_version=*/month_key=202602/*.parquet"))
    assert february
    warehouse.replace_months("analytics", "f", spark.createDataFrame([(20260115, "x")], first.schema), month_of("date_key"))
    assert rows(warehouse.read("analytics", "f")) == [(20260115, "x"), (20260215, "c")]
    assert sorted(p.name for p in (tmp_path / "analytics/f").glob("table_version=*/month_key=202602/*.parquet")) == february


def test_only_the_asked_months_are_read(spark, built, rows):
    work, tables = built
    warehouse = Warehouse(spark, f"{work}/warehouse")
    months = spark.createDataFrame([(202603,), (209901,)], f"{MONTH} int")
    found = warehouse.read_months("staging", "stg_ledger_transactions", months)
    assert found.count() == 1000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "month_key" in plan[plan.index("PartitionFilters") :].split("]")[0]


COPIES = "k string, day int, seq int, v string, month int"


def merged(spark, work):
    return spark.read.parquet(f"{work}/latest").select("k", "day", "seq", "v", "month")


def merger(work, checkpoint="c1"):
    write_text(f"{work}/{checkpoint}/metadata", f'{{"id":"{checkpoint}"}}')
    return latest_copy_merge(f"{work}/latest", f"{work}/slots", ["k", "day"], ["seq", "v"], "month", f"{work}/{checkpoint}")


def test_incremental_merge_equals_latest_copy(spark, tmp_path, rows):
    batches = [
        [("a", 20260101, 1, "x", 202601), ("a", 20260201, 1, "x", 202602), ("b", 20260101, 5, "x", 202601)],
        [("a", 20260101, 2, "y", 202601), ("b", 20260101, 4, "old", 202601), ("c", 20260301, 1, "z", 202603)],
        [("a", 20260201, 1, "y", 202602), ("d", 20260101, 1, "w", 202601)],
    ]
    merge = merger(tmp_path)
    for number, batch in enumerate(batches):
        merge(spark.createDataFrame(batch, COPIES), number)
        merge(spark.createDataFrame(batch, COPIES), number)  # a repeated batch changes nothing
    everything = spark.createDataFrame([row for batch in batches for row in batch], COPIES)
    assert rows(merged(spark, tmp_path)) == rows(latest_by(everything, ["k", "day"], ["seq", "v"]))


def test_interrupted_publish_is_repeated_from_the_slot(spark, tmp_path, rows):
    merge = merger(tmp_path)
    merge(spark.createDataFrame([("a", 20260101, 1, "x", 202601), ("b", 20260102, 1, "x", 202601)], COPIES), 0)
    second = spark.createDataFrame([("a", 20260101, 2, "y", 202601)], COPIES)
    merge(second, 1)
    wanted = rows(merged(spark, tmp_path))
    # as if the run had died while the month was being replaced
    lost = spark.createDataFrame([("a", 20260101, 2, "y", 202601)], COPIES)
    lost.write.mode("overwrite").partitionBy("month").parquet(f"{tmp_path}/latest")
    assert rows(merged(spark, tmp_path)) != wanted
    merge(second, 1)
    assert rows(merged(spark, tmp_path)) == wanted


def test_a_new_checkpoint_starts_over(spark, tmp_path, rows):
    """Batch 0 of another checkpoint is a batch of its own."""
    merger(tmp_path)(spark.createDataFrame([("a", 20260101, 1, "x", 202601)], COPIES), 0)
    merger(tmp_path, "c2")(spark.createDataFrame([("new", 20260101, 1, "y", 202601)], COPIES), 0)
    assert rows(merged(spark, tmp_path), "k") == [("a",), ("new",)]


def test_second_run_changes_nothing(spark, built, rows):
    work, tables = built
    before = rows(tables["fact_daily_portfolio_summary"])
    again = run_all(spark, f"{work}/landing", f"{work}/warehouse")
    assert rows(again["fact_daily_portfolio_summary"]) == before
    assert rows(tables["fact_daily_portfolio_summary"]) == before  # frames of the first run still work
    warehouse = Warehouse(spark, f"{work}/warehouse")
    dropped = warehouse.drop_old_versions()
    assert len(dropped) == len(tables) and warehouse.drop_old_versions() == []
    assert rows(warehouse.read(ANALYTICS, "fact_daily_portfolio_summary")) == before
    assert rows(spark.sql("select * from analytics.fact_daily_portfolio_summary")) == before
