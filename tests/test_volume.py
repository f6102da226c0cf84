"""What moves and what is stored: less of both, with the same rows."""

from __future__ import annotations

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from halala.operators import asof, lookup
from halala.operators.asof import asof_join
from halala.functions.keys import packed, unpacked
from halala.operators.lookup import remember_size, settle
from halala.plans import dimensions, facts
from halala.plans.refresh import changed_prices, changed_quotes
from halala.plans.staging import stg_equity_prices
from halala.quality import ledger
from halala.schemas import LEDGER_FILE_COLUMNS
from halala.sources.warehouse import Warehouse, month_of
from halala.streaming.load_once import _not_loaded
from tests.fixtures import DAY0, book, ledger_row
from workload import inputs

HOLDINGS = "client_key string, date_key int, asset_key string, quantity decimal(18,4), value_sar double, fees decimal(18,4)"
PRICES = "asset_key string, date_key int, price_sar double, loaded_at int, source_key string"


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def codecs(folder) -> set[str]:
    files = list(folder.rglob("*.parquet"))
    return {pq.ParquetFile(f).metadata.row_group(0).column(0).compression for f in files}


def test_months_are_written_where_their_rows_are(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path))
    first = spark.createDataFrame([(20260100 + d, "a") for d in range(1, 9)], "date_key int, v string").repartition(4, "date_key")
    stored = warehouse.rebuild_by_month("analytics", "f", first, month_of("date_key"))
    assert rows(stored) == rows(first)
    tasks = sum(1 for part in first.rdd.glom().collect() if part)
    assert tasks > 1
    assert len(list((tmp_path / "analytics/f").rglob("*.parquet"))) == tasks  # a shuffle by month made it one
    assert codecs(tmp_path / "analytics/f") == {"ZSTD"}


def test_settled_rows_are_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(lookup, "scratch_path", lambda _: str(tmp_path / "settled"))
    settle(spark.range(10).selectExpr("id", "md5(cast(id as string)) as key"))
    assert codecs(tmp_path / "settled") == {"ZSTD"}


@pytest.fixture
def trades(spark):
    holdings = [("c1", 20260105, "a", 1, 10.0, 1), ("c1", 20260105, "a", 2, None, 1), ("c2", 20260101, "a", 5, 7.0, 1),
                ("c2", None, "b", 1, 3.0, 1), (None, 20260105, None, 1, 2.0, 1)]
    prices = [("a", 20260103, 2.0, 1, "s"), ("a", 20260103, 3.0, 2, "r"), ("a", 20260110, 9.0, 1, "s"), ("b", 20260101, 4.0, 1, "s")]
    typed = spark.createDataFrame(holdings, "c string, d int, a string, q int, v double, f int").toDF(*[c.split()[0] for c in HOLDINGS.split(", ")])
    for column in ("quantity", "fees"):
        typed = typed.withColumn(column, typed[column].cast("decimal(18,4)"))
    return typed, spark.createDataFrame(prices, PRICES)


def test_positions_meet_their_prices_where_they_were_added_up(spark, trades, rows, monkeypatch):
    holdings, prices = trades
    columns = ["client_key", "date_key", "invested", "value"]
    few = rows(facts.portfolio_values(holdings, prices), *columns)
    assert set(few) == {("c1", 20260105, 10.0, 9.0), ("c2", 20260101, 7.0, 0.0), ("c2", None, 3.0, 0.0), (None, 20260105, 2.0, 0.0)}

    holdings = settle(holdings)
    monkeypatch.setattr(asof, "BROADCAST_ROWS", 0)
    monkeypatch.setattr(asof, "settle", lambda _: pytest.fail("many answers are not copied"))
    monkeypatch.setattr(facts, "settle", lambda _: pytest.fail("stored trades are not copied"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = facts.portfolio_values(holdings, prices)
        plan = physical(many)
        assert rows(many, *columns) == few
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "hashpartitioning(client_key#" not in plan.split("SortMergeJoin", 1)[1]


def test_probes_may_be_named(spark, rows):
    left = spark.createDataFrame([(1, "a", 5), (2, "b", 5)], "id int, k string, t int")
    right = spark.createDataFrame([("a", 4, "x"), ("b", 4, "y")], "k string, t int, v string")
    found = asof_join(left, right, ["k"], "t", "t", {"v": "v"}, probes=left.where("k = 'a'"))
    assert rows(found, "id", "v") == [(1, "x"), (2, None)]


def test_two_states_of_prices_are_compared_once(spark, trades, rows):
    _, old = trades
    new = old.where("date_key <> 20260110")
    found = changed_prices(old, new)
    assert rows(found) == [("a", 20260103, False), ("a", 20260110, True)]
    assert optimized(found).count("LogicalRDD") == 2


def test_rows_of_a_file_are_not_brought_together(spark, tmp_path, rows):
    lines = spark.createDataFrame([("f", 1), ("f", 2), (None, 3)], "file_name string, n int")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = _not_loaded(lines, str(tmp_path / "raw"))
        plan = physical(left)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert left.count() == 3
    assert "SortMergeJoin" not in plan


def test_a_line_meets_the_instruments_without_its_columns(spark):
    lines = spark.createDataFrame([tuple(ledger_row(1, DAY0)[c] for c in LEDGER_FILE_COLUMNS)], ", ".join(f"{c} string" for c in LEDGER_FILE_COLUMNS))
    lines = lines.selectExpr("'f' as file_name", "*")
    many = ledger.ledger_violations(lines, book(spark))
    first = optimized(many).split("Join", 2)[1]
    assert "_rules" in first


@pytest.fixture
def lines(spark, tmp_path):
    """Folder with a few lines of two parts, one of them on two days."""
    made = [(1, 1, 7, 3, "1996-01-02", 5.0, 10.0, "N", "O"), (1, 2, 7, 3, "1996-01-02", 1.0, 12.5, "N", "O"),
            (2, 4, 7, 4, "1996-01-03", 2.0, 11.0, "A", "O"), (3, 4, 9, 4, "1996-01-03", 3.0, 8.0, "R", "F")]
    columns = "l_orderkey long, l_linenumber int, l_partkey long, l_suppkey long, day string, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string"
    rows = spark.createDataFrame(made, columns).selectExpr("* except (day)", "cast(day as date) as l_shipdate", "0.02D as l_tax", "0.05D as l_discount")
    rows.write.parquet(str(tmp_path / "lineitem.parquet"))
    return str(tmp_path)


def test_dimensions_read_few_columns_of_the_ledger(spark, lines, rows, monkeypatch):
    settled = []

    def recorded(df):
        settled.append(df.columns)
        return settle(df)

    monkeypatch.setattr(inputs, "settle", recorded)
    galaxy = inputs.Galaxy(spark, lines)
    assert rows(galaxy.dim_client) == rows(dimensions.dim_client(galaxy.ledger))
    assert galaxy.dim_client.count() == 2
    assert not any("transaction_id" in columns for columns in settled)
    assert galaxy.ledger_names.count() == 4
    assert galaxy.stg_ledger_transactions.columns == galaxy.ledger.columns


def test_lists_of_days_are_begun_where_they_end(spark, lines, rows):
    made = inputs.equity_prices_raw(spark, lines)
    staged = stg_equity_prices(made).withColumn("date", F.col("date").cast("string"))
    assert rows(staged, "ticker", "date", "low_price", "close_price", "volume") == [
        ("P7", "1996-01-02", 10.0, 12.5, 6),
        ("P7", "1996-01-03", 11.0, 11.0, 2),
        ("P9", "1996-01-03", 8.0, 8.0, 3),
    ]
    plan = physical(made)
    assert "Exchange" not in plan[plan.index("collect_list") : plan.index("partial_collect_list")]


def test_prices_that_met_their_assets_by_ticker_stay_there(spark, rows, monkeypatch):
    quotes = spark.sql("""
        select ticker, cast(date as date) as date, price, source_name, loaded_at, observed_at, 'USD' as currency_code
        from values ('a', '2026-01-05', 2D, 's', 1, 1), ('a', '2026-01-05', 3D, 's', 1, 2), ('b', '2026-01-05', 4D, 's', 1, 1),
                    ('b', '2026-01-06', 5D, null, 1, 1), (null, '2026-01-05', 9D, 's', 1, 1)
             as t(ticker, date, price, source_name, loaded_at, observed_at)""")
    fx = spark.sql("select date'2026-01-01' as rate_date, 'USD' as currency_code, 3.75D as rate_to_sar")
    assets = spark.sql("select md5(ticker) as asset_key, ticker from values ('a'), ('b') as t(ticker)")
    dates = spark.sql("select d as full_date, 20260100 + day(d) as date_key from values (date'2026-01-05'), (date'2026-01-06') as t(d)")
    currency = spark.sql("select 'USD' as currency_code, md5('USD') as currency_key")
    source = spark.sql("select 's' as source_name, md5('s') as source_key")
    monkeypatch.setattr(lookup, "checked_broadcast", lambda df: df if "asset_key" in df.columns else F.broadcast(df))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = facts.market_prices_of(quotes, fx, assets, dates, currency, source)
        plan = physical(found)
        assert rows(found, "date_key", "price", "price_sar") == [(20260105, 3.0, 11.25), (20260105, 4.0, 15.0), (20260106, 5.0, 18.75)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan
    assert "hashpartitioning(asset_key" not in plan


def test_keys_are_packed_and_unpacked(spark):
    digest = "0123456789abcdef" * 2
    keys = [digest, digest.upper(), digest[:31] + "\n", digest + "\n", "a" * 16, "a" * 15 + "\0", "\0", "", "x", None, "é" * 8, "a" * 16 + "\0" * 16, "z" * 32]
    made = spark.createDataFrame([(k,) for k in keys], "k string").select("k", packed("k").alias("p")).select("k", "p", unpacked("p").alias("back")).collect()
    assert [r["back"] for r in made] == keys
    assert len({bytes(r["p"]) for r in made if r["p"] is not None}) == len(keys) - 1
    assert len(made[0]["p"]) == 16


def test_portfolios_are_valued_with_packed_keys(spark, trades, rows, monkeypatch):
    holdings, prices = trades
    digests = holdings.withColumn("client_key", F.md5("client_key")).withColumn("asset_key", F.md5("asset_key"))
    found = facts.portfolio_values(digests, prices.withColumn("asset_key", F.md5("asset_key")))
    assert "client_key#" in physical(found) and found.schema["client_key"].dataType.typeName() == "string"
    plain = rows(facts.portfolio_values(holdings, prices).withColumn("client_key", F.md5("client_key")))
    assert rows(found) == plain
    assert dict(facts.packed_trades(digests).dtypes)["asset_key"] == "binary"


def test_ties_of_day_keys_are_told_in_the_merge(spark, rows, monkeypatch):
    monkeypatch.setattr(asof, "_may_be_few", lambda *_: False)
    left = spark.createDataFrame([("a", 5), ("a", 3), ("b", 9)], "k string, t int")
    right = spark.createDataFrame([("a", 3, 1, "x", 1.0), ("a", 3, 2, None, 2.0), ("a", 3, 2, "r", 3.0), ("a", 3, None, "z", 4.0), ("b", 9, 1, "s", None)], "k string, t int, l int, s string, v double")
    found = [asof_join(left, right, ["k"], "t", "t", {"v": "v"}, tie=["l", "s"], few_ties=few) for few in (False, True)]
    assert rows(found[0]) == rows(found[1]) == [("a", 3, 3.0), ("a", 5, 3.0), ("b", 9, None)]
    assert physical(found[1]).count("Window") < physical(found[0]).count("Window")


def test_few_tasks_write_the_files_of_months(spark, tmp_path, rows):
    warehouse = Warehouse(spark, str(tmp_path))
    tasks = spark.sparkContext.defaultParallelism + 3
    first = settle(spark.range(1, 29).selectExpr("cast(20260100 + id as int) as date_key", "id as v").repartition(tasks, "date_key"))
    stored = warehouse.rebuild_by_month("analytics", "f", remember_size(first.repartition(tasks, "v"), 28, 1000), month_of("date_key"))
    assert rows(stored) == rows(first)
    assert len(list((tmp_path / "analytics/f").rglob("*.parquet"))) <= tasks - 3


def test_changed_quotes_are_those_of_one_state_only(spark, rows):
    columns = "ticker string, date int, price double, source string"
    before = spark.createDataFrame([("a", 1, 1.0, "s"), ("a", 2, 2.0, "s"), ("b", 1, None, "s"), ("c", 1, 5.0, "s"), ("d", 1, 1.0, "s"), (None, 1, 1.0, "s")], columns)
    after = spark.createDataFrame([("a", 1, 1.0, "s"), ("a", 2, 2.5, "s"), ("b", 1, None, "s"), ("d", 1, 1.0, "s"), ("d", 1, 1.0, "s"), ("e", 3, 1.0, "s")], columns)
    assert rows(changed_quotes(before, after)) == [("a", 2), ("c", 1), ("d", 1), ("e", 3)]
    assert physical(changed_quotes(before, after)).count("Exchange hashpartitioning") == 1


def test_prices_and_dimensions_read_few_columns_of_the_equities(spark, lines, rows):
    galaxy = inputs.Galaxy(spark, lines)
    assert galaxy.equity_closes.columns == ["ticker", "date", "close_price", "loaded_at"]
    whole = inputs.Galaxy(spark, lines)
    whole.keep_whole()
    assert whole.equity_closes is whole.stg_equity_prices and whole.ledger_names is whole.stg_ledger_transactions
    assert rows(galaxy.dim_client) == rows(whole.dim_client)


def test_many_answers_stay_off_the_driver(spark, rows, monkeypatch):
    left = spark.createDataFrame([("a", 5), ("a", 3), ("b", 9)], "k string, t int")
    right = spark.createDataFrame([("a", 3, 1.0), ("b", 9, None)], "k string, t int, v double")
    monkeypatch.setattr(asof, "ANSWER_ROWS", 2)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = asof_join(left, right, ["k"], "t", "t", {"v": "v"})
        assert rows(found) == [("a", 3, 1.0), ("a", 5, 1.0), ("b", 9, None)]
        assert "SortMergeJoin" in physical(found)  # a million answers were broadcast
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
