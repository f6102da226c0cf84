from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest

from halala.plans import fx as fx_plan
from halala.plans import staging
from tests.fixtures import DAY0, bar, equities, fx, ledger_row, metals, raw_documents, raw_ledger

T1, T2 = dt.datetime(2026, 3, 20), dt.datetime(2026, 3, 21)


def test_exchange_rates_keep_the_latest_successful_copy(spark, rows):
    raw = raw_documents(
        spark,
        [
            (fx(DAY0, {"SAR": 3.7, "GBP": 0.7}), "exchange_rates/a.json", T1),
            (fx(DAY0, {"SAR": 3.8}), "exchange_rates/b.json", T1),  # same load time, greater name
            (fx(DAY0, {"SAR": 9.9}, success=False), "exchange_rates/c.json", T2),
            (fx(DAY0, {"SAR": 4.4}, base="EUR"), "exchange_rates/d.json", T2),
            (fx(DAY0, {}), "exchange_rates/e.json", T2),
            ('{"success": true, "timestamp": 1, "base": "USD", "date": "2026-03-02"}', "exchange_rates/f.json", T2),
        ],
    )
    staged = staging.stg_exchange_rates(raw)
    assert rows(staged, "rate_date", "base_currency", "target_currency", "exchange_rate", "file_name") == [
        (DAY0, "EUR", "SAR", Decimal("4.400000"), "exchange_rates/d.json"),
        (DAY0, "USD", "GBP", Decimal("0.700000"), "exchange_rates/a.json"),
        (DAY0, "USD", "SAR", Decimal("3.800000"), "exchange_rates/b.json"),
    ]


def test_exchange_rate_values_that_do_not_parse(spark, rows):
    """A rate in quotes counts as a number; this differs from an engine that keeps the quotes."""
    raw = raw_documents(
        spark, [(fx(DAY0, {"SAR": "3.75", "GBP": "n/a", "CHF": None, "USD": 1e0}), "exchange_rates/a.json", T1)]
    )
    assert rows(staging.stg_exchange_rates(raw), "target_currency", "exchange_rate") == [
        ("CHF", None),
        ("GBP", None),
        ("SAR", Decimal("3.750000")),
        ("USD", Decimal("1.000000")),
    ]


def test_metals_let_a_later_failure_hide_a_good_document(spark, rows):
    other = DAY0 + dt.timedelta(days=1)
    raw = raw_documents(
        spark,
        [
            (metals(DAY0, XAU=4000.1234567891), "metal_prices/a.json", T1),
            (metals(DAY0, success=False, XAU=1.0), "metal_prices/b.json", T2),
            (metals(other, XAU=4100, XAG=61), "metal_prices/c.json", T1),
        ],
    )
    assert rows(staging.stg_precious_metals(raw), "success", "api_timestamp", "gold_usd", "silver_usd") == [
        (False, dt.datetime(2026, 3, 2, 23, 59, 59), Decimal("1.000000000000"), None),
        (True, dt.datetime(2026, 3, 3, 23, 59, 59), Decimal("4100.000000000000"), Decimal("61.000000000000")),
    ]


def test_a_wrong_epoch_fails_the_build(spark):
    raw = raw_documents(spark, [('{"success": true, "timestamp": "soon", "rates": {"SAR": 1}}', "a.json", T1)])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        staging.stg_precious_metals(raw).collect()


def test_equities_explode_two_levels_and_keep_the_latest_copy(spark, rows):
    first = equities({"IBM": {"2026-03-02": bar(100), "2026-03-03": bar(101)}, "SAP": {"2026-03-02": bar(200)}})
    second = equities({"IBM": {"2026-03-03": bar(111), "2026-03-04": bar(112)}, "VOD": {}})
    noise = '{"Meta Data": {"1. Information": "x"}, "Information": "limit reached", "GLD": {"Note": "no series"}}'
    raw = raw_documents(
        spark, [(first, "equity_prices/a.json", T1), (second, "equity_prices/b.json", T2), (noise, "equity_prices/c.json", T2)]
    )
    staged = staging.stg_equity_prices(raw)
    assert rows(staged, "ticker", "date", "close_price", "volume", "source") == [
        ("IBM", dt.date(2026, 3, 2), 100.0, 1000, "alpha_vantage"),
        ("IBM", dt.date(2026, 3, 3), 111.0, 1000, "alpha_vantage"),
        ("IBM", dt.date(2026, 3, 4), 112.0, 1000, "alpha_vantage"),
        ("SAP", dt.date(2026, 3, 2), 200.0, 1000, "alpha_vantage"),
    ]


def test_equity_values_that_do_not_parse(spark, rows):
    broken = {**bar(10), "4. close": "n/a", "5. volume": "1.5"}
    del broken["2. high"]
    raw = raw_documents(spark, [(equities({"IBM": {"someday": bar(1), "2026-03-02": broken}}), "a.json", T1)])
    assert rows(staging.stg_equity_prices(raw), "date", "high_price", "close_price", "volume") == [
        (None, 2.0, 1.0, 1000),
        (dt.date(2026, 3, 2), None, None, None),
    ]


def test_ledger_types(spark, rows):
    good = ledger_row(1, DAY0)
    bad = ledger_row(2, DAY0, quantity="many", transaction_date="2026", transaction_ts="soon", fee_amount="")
    staged = staging.stg_ledger_transactions(raw_ledger(spark, [good, bad]))
    assert rows(staged, "quantity", "fees", "currency_code", "transaction_ts", "transaction_date", "batch_id") == [
        (Decimal("11.0000"), Decimal("7.5000"), "USD", dt.datetime(2026, 3, 2, 9), DAY0, "b1"),
        (None, None, "USD", None, None, "b1"),
    ]


def rates_frame(spark, quotes):
    quotes = [(d, b, t, Decimal(str(r)) if r is not None else None) for d, b, t, r in quotes]
    return spark.createDataFrame(
        quotes, "rate_date date, base_currency string, target_currency string, exchange_rate decimal(38,6)"
    )


def test_triangulation_prefers_usd_and_rebases_eur(spark):
    d1, d2, d3, d4 = (DAY0 + dt.timedelta(days=i) for i in range(4))
    staged = rates_frame(
        spark,
        [
            (d1, "EUR", "USD", 1.25),
            (d1, "EUR", "SAR", 4.5),
            (d1, "EUR", "GBP", 0.8),
            (d1, "USD", "GBP", 0.75),  # both bases on one date: USD wins
            (d2, "USD", "SAR", 3.75),
            (d2, "USD", "USD", 1),
            (d2, "USD", "CHF", 0),  # zero and negative rates are no rates
            (d2, "USD", "GBP", -1),
            (d3, "USD", "GBP", 0.7),  # no SAR rate on this date
            (d4, "EUR", "SAR", 4.4),  # no EUR->USD rate on this date
            (None, "USD", "SAR", 3.75),
        ],
    )
    found = {(r.rate_date, r.currency_code): r.rate_to_sar for r in fx_plan.int_fx_rates_to_sar(staged).collect()}
    usd_sar = 4.5 / 1.25
    assert found == {
        (d1, "USD"): usd_sar / (1.25 / 1.25),
        (d1, "SAR"): 1.0,
        (d1, "EUR"): usd_sar / (1 / 1.25),
        (d1, "GBP"): usd_sar / 0.75,
        (d2, "SAR"): 1.0,
        (d2, "USD"): 3.75,
    }


def test_rebased_documents(spark, rows):
    raw = raw_documents(spark, [(fx(DAY0, {"SAR": 4.35, "USD": 1.16, "GBP": 0.85}, base="EUR", note="x"), "a.json", T1)])
    found = json.loads(fx_plan.rebased_documents(raw).first()["raw"])
    assert found.pop("rates") == pytest.approx({"SAR": 4.35 / 1.16, "USD": 1.0, "GBP": 0.85 / 1.16}, abs=1e-6)
    assert found == {"success": True, "timestamp": 1772495999, "base": "USD", "date": "2026-03-02", "note": "x"}
    staged = staging.stg_exchange_rates(fx_plan.rebased_documents(raw))
    assert rows(staged, "base_currency", "target_currency", "exchange_rate")[1] == ("USD", "SAR", Decimal("3.750000"))


def test_triangulation_takes_one_shuffle(spark):
    staged = rates_frame(spark, [(DAY0, "USD", "SAR", 3.75)])
    plan = fx_plan.int_fx_rates_to_sar(staged)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
