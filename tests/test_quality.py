from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from halala.quality import gates, ledger, payloads
from halala.schemas import LEDGER_FILE_COLUMNS
from tests.fixtures import DAY0, TICKERS, bar, book, equities, fx, ledger_row, metals, raw_documents

T1 = dt.datetime(2026, 3, 20)


def failures(report) -> dict:
    return {(r["table"], r["gate"], r["columns"]): r["failures"] for r in report.collect()}


def test_there_are_79_gates(spark):
    rules = gates.row_gates()
    kinds = [g.kind for per_table in rules.values() for g in per_table]
    assert kinds.count("not_null") == 43
    assert kinds.count("accepted_values") == 7
    assert kinds.count("accepted_range") == 3
    assert kinds.count("expression") == 2
    uniques = [columns for per_table in gates.UNIQUE.values() for columns in per_table]
    assert len([c for c in uniques if len(c) == 1]) == 12
    assert len([c for c in uniques if len(c) > 1]) == 2
    keys = [k for per_table in gates.FOREIGN_KEYS.values() for k in per_table]
    assert len(keys) == 10
    assert len(kinds) + len(uniques) + len(keys) == 79


def test_row_gates_count_violations_and_let_nulls_pass(spark):
    df = spark.createDataFrame([("USD", 1.0), ("JPY", 0.0), (None, -1.0), ("EUR", None)], "c string, n double")
    rules = [
        *gates.not_null("c", "n"),
        *gates.accepted_values("c", ["USD", "EUR"]),
        *gates.above("n", 0),
        *gates.expression("n_is_one", F.col("n") != 1),
    ]
    assert failures(gates.check_rows(df, "t", rules)) == {
        ("t", "not_null", "c"): 1,
        ("t", "not_null", "n"): 1,
        ("t", "accepted_values", "c"): 1,
        ("t", "accepted_range", "n"): 2,
        ("t", "expression", "n_is_one"): 2,
    }


def test_unique_gates(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 1), (None, 2), (None, 2)], "k string, n int")
    assert failures(gates.check_unique(df, "t", "k")) == {("t", "unique", "k"): 1}
    assert failures(gates.check_unique(df, "t", "k", "n")) == {("t", "unique_combination", "k, n"): 2}
    assert failures(gates.check_unique(df.dropDuplicates(), "t", "k")) == {("t", "unique", "k"): 0}


def test_relationship_gate(spark):
    child = spark.createDataFrame([("a",), ("x",), ("x",), (None,)], "k string")
    parent = spark.createDataFrame([("a",), ("b",)], "k string")
    assert failures(gates.check_relationship(child, "t", "k", parent, "k")) == {("t", "relationships", "k"): 2}
    assert failures(gates.check_relationship(parent, "t", "k", parent, "k")) == {("t", "relationships", "k"): 0}


def test_empty_tables_pass(spark):
    empty = spark.createDataFrame([], "k string")
    report = gates.check_rows(empty, "t", gates.not_null("k")).unionByName(gates.check_unique(empty, "t", "k"))
    report = report.unionByName(gates.check_relationship(empty, "t", "k", empty, "k"))
    assert set(failures(report).values()) == {0}
    gates.enforce(report)


def test_enforce_names_every_failed_gate(spark):
    df = spark.createDataFrame([(None,), ("a",), ("a",)], "k string")
    report = gates.check_rows(df, "t", gates.not_null("k")).unionByName(gates.check_unique(df, "t", "k"))
    with pytest.raises(gates.GateFailure) as raised:
        gates.enforce(report)
    assert str(raised.value) == "t: not_null(k) failed 1 times\nt: unique(k) failed 1 times"


def test_business_gates(spark):
    rules = gates.row_gates()
    sar = spark.createDataFrame(
        [("SAR", 1.0), ("SAR", 1.0000001), ("SAR", 1.1), ("USD", 3.75)], "currency_code string, rate_to_sar double"
    )
    found = failures(gates.check_rows(sar, "fx", rules["int_fx_rates_to_sar"]))
    assert found == {("fx", "expression", "sar_rate_is_one"): 1}
    rate = next(g for g in rules["fact_holdings"] if g.kind == "expression")
    holdings = spark.createDataFrame([(1.0, 1.0), (None, None), (1.0, None)], "exchange_rate double, value_sar double")
    assert failures(gates.check_rows(holdings, "h", [rate])) == {("h", "expression", "holdings_have_fx_rate"): 2}


def test_rate_documents(spark, rows):
    good = {"USD": 1, "SAR": 3.75, "GBP": 0.7, "CHF": 0.8}
    docs = {
        "good": fx(DAY0, good),
        "failed": fx(DAY0, {}, success=False),
        "text": fx(DAY0, good | {"SAR": "3.75"}),
        "zero": fx(DAY0, good | {"GBP": 0, "CHF": -1}),
        "gap": fx(DAY0, {k: v for k, v in good.items() if k != "USD"}),
        "null": fx(DAY0, good | {"USD": None}),
        "none": '{"success": true}',
    }
    raw = raw_documents(spark, [(text, name, T1) for name, text in docs.items()])
    bad = "missing_or_invalid_rate"
    assert rows(payloads.rate_violations(raw, payloads.FX_SYMBOLS)) == sorted(
        [("failed", "not_success", None), ("text", bad, "SAR"), ("zero", bad, "GBP"), ("zero", bad, "CHF")]
        + [("gap", bad, "USD"), ("null", bad, "USD")]
        + [("none", bad, s) for s in payloads.FX_SYMBOLS],
        key=repr,
    )
    metal = raw_documents(spark, [(metals(DAY0, XAU=1, XAG=2, XPT=3), "m", T1)])
    assert rows(payloads.rate_violations(metal, payloads.METAL_SYMBOLS)) == [("m", bad, "XPD")]


def test_equity_documents(spark, rows):
    full = {t: {"2026-03-02": bar(10)} for t in TICKERS}
    gap = bar(10)
    del gap["5. volume"]
    docs = {
        "good": equities(full),
        "short": equities({t: d for t, d in full.items() if t != "IBM"}),
        "empty": equities(full | {"SAP": {}}),
        "gap": equities(full | {"VOD": {"2026-03-03": gap}}),
    }
    raw = raw_documents(spark, [(text, name, T1) for name, text in docs.items()])
    assert rows(payloads.equity_violations(raw, payloads.EQUITY_TICKERS)) == [
        ("empty", "no_series", "SAP"),
        ("gap", "missing_field", "VOD/2026-03-03/5. volume"),
        ("short", "missing_ticker", "IBM"),
    ]


def test_refuse_lists_what_it_found(spark):
    raw = raw_documents(spark, [(fx(DAY0, {}, success=False), "a.json", T1)])
    with pytest.raises(payloads.PayloadError, match="a.json not_success"):
        payloads.refuse(payloads.rate_violations(raw, payloads.FX_SYMBOLS))
    payloads.refuse(payloads.rate_violations(raw.where("false"), payloads.FX_SYMBOLS))


def lines_frame(spark, lines, file_name="b.csv"):
    schema = ", ".join(f"{c} string" for c in LEDGER_FILE_COLUMNS)
    return spark.createDataFrame([tuple(l[c] for c in LEDGER_FILE_COLUMNS) for l in lines], schema).withColumn(
        "file_name", F.lit(file_name)
    )


@pytest.mark.parametrize(
    ("changes", "broken"),
    [
        ({}, []),
        ({"client_id": "C999"}, ["unknown_client"]),
        ({"client_name": "Somebody"}, ["client_name_mismatch"]),
        ({"portfolio_id": "P999"}, ["unknown_portfolio"]),
        ({"ticker": "ZZZ"}, ["unknown_ticker"]),
        ({"currency": "EUR"}, ["currency_mismatch"]),
        ({"transaction_type": "GIFT"}, ["unknown_type"]),
        ({"quantity": "0"}, ["not_positive"]),
        ({"fee_amount": "none"}, ["not_positive", "total_mismatch"]),
        ({"total": "1.00"}, ["total_mismatch"]),
        ({"price": "10.00", "quantity": "3", "fee_amount": "0.50", "total": "30.51"}, ["total_mismatch"]),
        ({"price": "10.00", "quantity": "3", "fee_amount": "0.50", "total": "30.50"}, []),
        ({"total": "abc"}, ["total_mismatch"]),
        ({"total": ""}, ["missing_total", "total_mismatch"]),
        ({"total": "999999999999999.00"}, ["total_mismatch"]),
        ({"price": "10.00", "quantity": "3", "fee_amount": "0.50", "total": "30.505"}, ["total_mismatch"]),
        ({"price": "1.00", "quantity": "200000000000000", "fee_amount": "1.00", "total": "200000000000001.00"}, []),
        ({"price": "2000000000000000.5", "quantity": "3", "fee_amount": "1.00", "total": "6000000000000002.50"}, []),
        ({"price": "NaN"}, ["not_positive", "total_mismatch"]),
        ({"portfolio_id": ""}, ["missing_portfolio_id", "unknown_portfolio"]),
    ],
)
def test_ledger_rules(spark, changes, broken):
    row = ledger_row(1, DAY0, **changes)
    found = ledger.ledger_violations(lines_frame(spark, [row]), book(spark))
    assert sorted(r.rule for r in found.collect()) == broken


def test_sell_totals_are_negative(spark):
    sell = ledger_row(2, DAY0)
    assert Decimal(sell["total"]) < 0
    known = book(spark)
    assert ledger.ledger_violations(lines_frame(spark, [sell]), known).isEmpty()
    positive = sell | {"total": sell["total"].lstrip("-")}
    assert [r.rule for r in ledger.ledger_violations(lines_frame(spark, [positive]), known).collect()] == ["total_mismatch"]


def test_row_counts(spark, rows):
    lines = lines_frame(spark, [ledger_row(n, DAY0) for n in range(3)])
    expected = spark.createDataFrame([("b.csv", 3), ("c.csv", 2)], "file_name string, rows bigint")
    assert rows(ledger.row_count_violations(lines, expected)) == [("c.csv", 2, 0)]
