"""Facts and dimensions on small hand-made tables, and the shape of their plans."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from halala.operators import asof, lookup
from halala.operators.asof import asof_join
from halala.operators.lookup import attach
from halala.operators.pick import latest_by, prefer_by
from halala.operators.reshape import columns_to_rows, distinct_values
from halala.plans import dimensions, facts, staging
from tests.fixtures import DAY0, bar, equities, ledger_row, metals, raw_documents, raw_ledger

T1, T2 = dt.datetime(2026, 3, 20), dt.datetime(2026, 3, 21)
D = [DAY0 + dt.timedelta(days=i) for i in range(6)]


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def galaxy(spark):
    """Trades before the first rate, in a currency without rate, without price, and badly typed."""
    trades = [
        ledger_row(1, D[0], ticker="IBM", client_id="C1", client_name="One"),
        ledger_row(2, D[1], ticker="IBM", client_id="C1", client_name="One", quantity="4", price="10"),
        ledger_row(3, D[1], ticker="IBM", client_id="C1", client_name="One", quantity="6", price="20"),
        ledger_row(4, D[2], ticker="XAU", client_id="C1", client_name="One", currency="GBP"),
        ledger_row(5, D[4], ticker="NEW", client_id="C2", client_name="Two"),
        ledger_row(6, D[4], ticker="IBM", client_id="C2", client_name="Two", currency="JPY"),
        ledger_row(7, "someday", ticker="IBM", client_id="C2", client_name="Two"),
        ledger_row(8, D[5], ticker="XAU", client_id="C2", client_name="Two", price="n/a"),
    ]
    ledger = staging.stg_ledger_transactions(raw_ledger(spark, trades))
    rates = spark.createDataFrame(
        [(D[1], "USD", 3.75), (D[1], "SAR", 1.0), (D[3], "USD", 4.0), (D[2], "GBP", 5.0)],
        "rate_date date, currency_code string, rate_to_sar double",
    )
    fx = spark.createDataFrame([(D[1], "CHF"), (D[1], None)], "rate_date date, target_currency string")
    equity = staging.stg_equity_prices(
        raw_documents(spark, [(equities({"IBM": {str(D[1]): bar(50), str(D[3]): bar(60)}}), "e/a.json", T1)])
    )
    metal = staging.stg_precious_metals(
        raw_documents(
            spark,
            [
                (metals(D[2], XAU=4000), "m/a.json", T2),
                (metals(D[2], second=3600, XAU=3900), "m/b.json", T1),
                (metals(D[3], success=False, XAU=1), "m/c.json", T1),
            ],
        )
    )
    tables = {
        "ledger": ledger,
        "rates": rates,
        "equity": equity,
        "metals": metal,
        "asset": dimensions.dim_asset(equity, ledger),
        "client": dimensions.dim_client(ledger),
        "currency": dimensions.dim_currency(ledger, fx, rates),
        "date": dimensions.dim_date(ledger, equity, metal, fx),
        "source": dimensions.dim_source(spark),
    }
    tables["holdings"] = facts.fact_holdings(
        ledger, rates, tables["date"], tables["asset"], tables["client"], tables["currency"]
    )
    tables["prices"] = facts.fact_market_prices(
        equity, metal, rates, tables["asset"], tables["date"], tables["currency"], tables["source"]
    )
    return tables


def test_dimensions(galaxy, rows):
    assert rows(galaxy["asset"], "ticker", "asset_type", "sector") == [
        ("IBM", "EQUITY", "TECHNOLOGY"),
        ("NEW", "EQUITY", "OTHER"),
        ("XAG", "METAL", "METALS"),
        ("XAU", "METAL", "METALS"),
        ("XPD", "METAL", "METALS"),
        ("XPT", "METAL", "METALS"),
    ]
    assert rows(galaxy["client"], "client_id", "client_name") == [("C1", "One"), ("C2", "Two")]
    assert rows(galaxy["currency"], "currency_code") == [("CHF",), ("GBP",), ("JPY",), ("SAR",), ("USD",)]
    # a failed metal document still adds its date
    assert rows(galaxy["date"], "date_key") == [(20260302 + i,) for i in range(6)]
    march = galaxy["date"].where("date_key = 20260302").select("year", "quarter", "month", "day")
    assert rows(march) == [(2026, 1, 3, 2)]
    assert rows(galaxy["source"], "source_name", "source_type") == [
        ("EQUITY_API", "External"),
        ("Internal Ledger", "Internal"),
        ("Metal Market Data", "External"),
    ]


def test_every_sector(spark, rows):
    known = [("AAPL",), ("VOD",), ("GLD",), ("SPY",), ("SAP",), ("ZZZ",)]
    priced = spark.createDataFrame(known, "ticker string")
    none = spark.createDataFrame([], "ticker string")
    sectors = dict(rows(dimensions.dim_asset(priced, none), "ticker", "sector"))
    assert sectors["VOD"] == "TELECOMMUNICATIONS"
    assert sectors["GLD"] == sectors["SPY"] == "ETF"
    assert sectors["AAPL"] == sectors["SAP"] == "TECHNOLOGY"
    assert sectors["XPD"] == "METALS"
    assert sectors["ZZZ"] == "OTHER"


def test_holdings_values(galaxy, rows):
    found = rows(galaxy["holdings"], "date_key", "quantity", "signed_quantity", "exchange_rate", "fx_rate_date", "value_sar")
    dec = Decimal
    assert (20260302, dec("11.0000"), dec("11.0000"), None, None, None) in found  # before the first rate
    assert (20260303, dec("4.0000"), dec("-4.0000"), 3.75, D[1], 150.0) in found
    assert (20260303, dec("6.0000"), dec("6.0000"), 3.75, D[1], 450.0) in found
    assert any(r[0] == 20260304 and r[3] == 5.0 and r[4] == D[2] for r in found)
    assert any(r[0] == 20260306 and r[3] == 4.0 and r[4] == D[3] for r in found)  # two days old
    assert any(r[0] == 20260306 and r[3] is None and r[5] is None for r in found)  # no JPY rate
    assert any(r[0] is None and r[3] is None for r in found)  # no date
    assert any(r[0] == 20260307 and r[3] == 4.0 and r[5] is None for r in found)  # no price
    assert len(found) == 8
    assert galaxy["holdings"].schema["transaction_value"].dataType.scale == 8


def test_market_prices_take_the_latest_load(galaxy, rows):
    assert rows(galaxy["prices"], "date_key", "price", "exchange_rate", "fx_rate_date", "price_sar") == [
        (20260303, 50.0, 3.75, D[1], 187.5),
        (20260304, 4000.0, 3.75, D[1], 15000.0),
        (20260305, 60.0, 4.0, D[3], 240.0),
    ]


def test_daily_summary(galaxy, rows):
    summary = facts.fact_daily_portfolio_summary(galaxy["holdings"], galaxy["prices"])
    keys = {r.client_id: r.client_key for r in galaxy["client"].collect()}
    found = {
        (r.client_key, r.date_key): (r.total_investment, r.portfolio_value_sar, r.total_fees, r.daily_return, r.pnl_sar)
        for r in summary.collect()
    }
    one, two, d = keys["C1"], keys["C2"], Decimal
    # no price yet: worth 0, and the investment is unknown
    assert found[one, 20260302] == (None, d("0.0000"), d("7.5000"), d("0.000000"), None)
    # quantities add up whatever their side; the value before was 0, so the return is 0
    assert found[one, 20260303] == (d("600.0000"), d("1875.0000"), d("15.0000"), d("0.000000"), d("1275.0000"))
    value = d("14") * 15000
    expected_return = ((value - 1875) / 1875).quantize(d("0.000001"))
    assert found[one, 20260304][1] == value
    assert found[one, 20260304][3] == expected_return
    # an asset without price counts as 0 beside a priced one
    assert found[two, 20260306][1] == 16 * 240
    # the row without a date comes last in the client's history
    assert (two, None) in found
    assert len(found) == 6


def test_renamed_client_counts_twice(spark):
    trades = [ledger_row(1, D[1], client_id="C1", client_name=n, transaction_id=f"T{n}") for n in ("Old", "New")]
    ledger = staging.stg_ledger_transactions(raw_ledger(spark, trades))
    client = dimensions.dim_client(ledger)
    assert client.count() == 2
    assert attach(ledger, client, "client_id", "client_id", ["client_key"]).count() == 4


def test_two_sources_for_one_asset_and_day(spark, rows):
    prices = spark.createDataFrame(
        [("a", 20260302, "s1", 10.0, T1), ("a", 20260302, "s2", 11.0, T2), ("a", 20260303, "s1", None, T1)],
        "asset_key string, date_key int, source_key string, price_sar double, loaded_at timestamp",
    )
    positions = spark.createDataFrame([("a", 20260302), ("a", 20260309), (None, 20260302)], "asset_key string, date_key int")
    priced = facts.priced_positions(positions, prices)
    assert rows(priced, "asset_key", "date_key", "price_sar") == [("a", 20260302, 11.0), ("a", 20260309, 0.0), (None, 20260302, 0.0)]


def test_one_row_per_key(spark, rows):
    copies = spark.createDataFrame(
        [("a", 1, "x"), ("a", 2, "y"), ("a", None, "z"), (None, 1, "n"), (None, 2, "m")], "k string, n int, v string"
    )
    assert rows(latest_by(copies, ["k"], ["n"]), "k", "v") == [("a", "y"), (None, "m")]
    assert rows(prefer_by(copies, ["k"], ["n"]), "k", "v") == [("a", "x"), (None, "n")]


def test_set_operations(spark, rows):
    a = spark.createDataFrame([("x",), (None,), ("y",)], "c string")
    b = spark.createDataFrame([("y",), (None,), ("z",)], "d string")
    assert rows(distinct_values("code", [(a, "c"), (b, "d")])) == [("x",), ("y",), ("z",)]
    wide = spark.createDataFrame([(1, 2.0, None)], "id int, p double, q double")
    assert rows(columns_to_rows(wide, ["id"], {"p": "P", "q": "Q"}, "name", "value", "double")) == [(1, "P", 2.0)]


# ---- plans ----------------------------------------------------------------------------------


def test_no_nested_loops_or_cartesian_products(galaxy):
    summary = facts.fact_daily_portfolio_summary(galaxy["holdings"], galaxy["prices"])
    for df in [galaxy["holdings"], galaxy["prices"], summary]:
        plan = physical(df)
        assert "NestedLoop" not in plan
        assert "Cartesian" not in plan


def test_latest_copy_is_limited_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = physical(latest_by(frame, ["k"], ["id"]))
    partial, exchange = plan.index("Partial"), plan.index("Exchange")
    assert "WindowGroupLimit" in plan
    assert partial > exchange  # printed below, so executed before


def test_asof_beyond_the_bound_gives_the_same_rows(spark, monkeypatch, rows):
    day = F.date_add(F.lit(DAY0), (F.col("id") % 40).cast("int"))
    left = spark.range(500).select(F.concat(F.lit("K"), F.col("id") % 7).alias("k"), day.alias("t"), "id")
    right = spark.range(60).select(
        F.concat(F.lit("K"), F.col("id") % 6).alias("k"),
        F.date_add(F.lit(DAY0), (F.col("id") % 30).cast("int")).alias("t"),
        F.col("id").alias("v"),
    ).dropDuplicates(["k", "t"])
    for strict in (False, True):
        filled = asof_join(left, right, ["k"], "t", "t", {"v": "v", "t": "found"}, strict=strict)
        assert "Window" in physical(filled)
        wanted = rows(filled)
        with monkeypatch.context() as patch:
            patch.setattr(asof, "BROADCAST_ROWS", 10)
            patch.setattr(lookup, "is_small", lambda *_: False)
            merged = asof_join(left, right, ["k"], "t", "t", {"v": "v", "t": "found"}, strict=strict)
            assert "explode" not in physical(merged).lower()
            assert rows(merged) == wanted


def test_small_answers_spare_the_left_side_its_shuffle(spark):
    day = F.date_add(F.lit(DAY0), (F.col("id") % 10).cast("int"))
    left = spark.range(1000).select(F.concat(F.lit("K"), F.col("id") % 3).alias("k"), day.alias("t"), "id")
    right = spark.createDataFrame([("K1", DAY0, 3.75)], "k string, t date, v double")
    plan = physical(asof_join(left, right, ["k"], "t", "t", {"v": "v"}))
    assert "BroadcastHashJoin" in plan
    assert plan.count("Exchange hashpartitioning") == 1  # of the few known rows


def test_lookup_beyond_the_bound_is_not_broadcast(spark, monkeypatch):
    dim = spark.range(100).select("id", F.concat(F.lit("name"), "id").alias("name"))
    assert lookup.is_small(dim, max_rows=100)
    assert not lookup.is_small(dim, max_rows=99)
    assert not lookup.is_small(dim, max_bytes=1000)
    facts_frame = spark.range(1000).withColumnRenamed("id", "fk")
    hinted = attach(facts_frame, dim, "fk", "id", ["name"])
    assert "ResolvedHint (strategy=broadcast)" in hinted._jdf.queryExecution().analyzed().toString()
    monkeypatch.setattr(lookup, "is_small", lambda *_: False)
    plain = attach(facts_frame, dim, "fk", "id", ["name"])
    assert "ResolvedHint" not in plain._jdf.queryExecution().analyzed().toString()
    assert plain.where("name is not null").count() == 100
