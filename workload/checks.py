"""Gates and delivery checks as registered queries; the data holds violations of every rule."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from halala.operators.lookup import settle
from halala.operators.reshape import stack_rows
from halala.quality import gates, ledger, payloads
from workload.galaxy_sql import with_blocks
from workload.inputs import (
    Galaxy,
    equity_prices_raw,
    fx_rates_raw,
    ledger_lines,
    metal_prices_raw,
    table,
)
from workload.registry import register

# ---- gates ----------------------------------------------------------------------------------


@register(
    "gate_not_null",
    """
    SELECT 'orders' AS "table", 'not_null' AS gate, unnest(['o_orderkey', 'o_totalprice', 'status']) AS columns,
           unnest([count(*) - count(o_orderkey), count(*) - count(o_totalprice),
                   count(*) FILTER (o_orderstatus = 'P')]) AS failures
    FROM orders""",
)
def gate_not_null(spark: SparkSession, folder: str) -> DataFrame:
    status = F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus"))
    orders = table(spark, folder, "orders").withColumn("status", status)
    return gates.check_rows(orders, "orders", gates.not_null("o_orderkey", "o_totalprice", "status"))


@register(
    "gate_unique",
    """
    SELECT 'lineitem' AS "table", 'unique' AS gate, 'l_orderkey' AS columns, count(*) AS failures
    FROM (SELECT l_orderkey FROM lineitem GROUP BY l_orderkey HAVING count(*) > 1) AS d
    UNION ALL
    SELECT 'orders', 'unique', 'o_orderkey', count(*)
    FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(*) > 1) AS d""",
)
def gate_unique(spark: SparkSession, folder: str) -> DataFrame:
    return stack_rows(
        gates.check_unique(table(spark, folder, "lineitem"), "lineitem", "l_orderkey"),
        gates.check_unique(table(spark, folder, "orders"), "orders", "o_orderkey"),
    )


@register(
    "gate_unique_combination",
    """
    SELECT 'lineitem' AS "table", 'unique_combination' AS gate, 'l_orderkey, l_linenumber' AS columns,
           count(*) AS failures
    FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) AS d""",
)
def gate_unique_combination(spark: SparkSession, folder: str) -> DataFrame:
    return gates.check_unique(table(spark, folder, "lineitem"), "lineitem", "l_orderkey", "l_linenumber")


@register(
    "gate_accepted_values",
    """
    SELECT 'orders' AS "table", 'accepted_values' AS gate, unnest(['o_orderstatus', 'o_orderpriority']) AS columns,
           unnest([count(*) FILTER (o_orderstatus NOT IN ('F', 'O')),
                   count(*) FILTER (o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM'))]) AS failures
    FROM orders""",
)
def gate_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    rules = [
        *gates.accepted_values("o_orderstatus", ["F", "O"]),
        *gates.accepted_values("o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"]),
    ]
    return gates.check_rows(table(spark, folder, "orders"), "orders", rules)


@register(
    "gate_accepted_range",
    """
    SELECT 'lineitem' AS "table", 'accepted_range' AS gate, unnest(['l_discount', 'l_tax']) AS columns,
           unnest([count(*) FILTER (NOT l_discount > 0), count(*) FILTER (NOT l_tax > 0)]) AS failures
    FROM lineitem""",
)
def gate_accepted_range(spark: SparkSession, folder: str) -> DataFrame:
    rules = [*gates.above("l_discount", 0), *gates.above("l_tax", 0)]
    return gates.check_rows(table(spark, folder, "lineitem"), "lineitem", rules)


@register(
    "gate_relationships",
    """
    SELECT 'customer' AS "table", 'relationships' AS gate, 'c_custkey' AS columns, count(*) AS failures
    FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')
    UNION ALL
    SELECT 'lineitem', 'relationships', 'l_partkey', count(*)
    FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_type <> 'ECONOMY')
    UNION ALL
    SELECT 'lineitem', 'relationships', 'l_orderkey', count(*)
    FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders)""",
)
def gate_relationships(spark: SparkSession, folder: str) -> DataFrame:
    lineitem, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    served = orders.where("o_orderstatus = 'F'")
    parts = table(spark, folder, "part").where("p_type <> 'ECONOMY'")
    return stack_rows(
        gates.check_relationship(table(spark, folder, "customer"), "customer", "c_custkey", served, "o_custkey"),
        gates.check_relationship(lineitem, "lineitem", "l_partkey", parts, "p_partkey"),
        gates.check_relationship(lineitem, "lineitem", "l_orderkey", orders, "o_orderkey"),
    )


@register(
    "gate_sar_rate",
    with_blocks("""
    SELECT 'int_fx_rates_to_sar' AS "table", 'expression' AS gate, 'sar_rate_is_one' AS columns,
           count(*) FILTER (currency_code = 'SAR' AND day(rate_date) = 13) AS failures
    FROM sar"""),
)
def gate_sar_rate(spark: SparkSession, folder: str) -> DataFrame:
    """The gate on the rate of the riyal, with rates that break it on one day of each month."""
    rates = Galaxy(spark, folder).int_fx_rates_to_sar
    off = (F.col("currency_code") == "SAR") & (F.dayofmonth("rate_date") == 13)
    broken = rates.withColumn("rate_to_sar", F.when(off, F.lit(1.00001)).otherwise(F.col("rate_to_sar")))
    return gates.check_rows(broken, "int_fx_rates_to_sar", gates.row_gates()["int_fx_rates_to_sar"])


@register(
    "gate_expression",
    """
    SELECT 'lineitem' AS "table", 'expression' AS gate, 'shipped_after_start' AS columns,
           count(*) FILTER (CAST(l_shipdate AS DATE) <= DATE '1996-01-01') AS failures
    FROM lineitem""",
)
def gate_expression(spark: SparkSession, folder: str) -> DataFrame:
    early = F.col("l_shipdate").cast("date") <= F.lit("1996-01-01").cast("date")
    return gates.check_rows(
        table(spark, folder, "lineitem"), "lineitem", gates.expression("shipped_after_start", early)
    )


# Each gate of the thirteen tables: the tables as SQL, then one count per gate.
_TABLE_SQL = {
    "stg_precious_metals": "SELECT 1 AS success, 1 AS base_currency, day, status = 'P' AS early, "
    "xau AS gold_usd, xag AS silver_usd, xpt AS platinum_usd, xpd AS palladium_usd FROM metal_latest",
    "stg_ledger_transactions": "SELECT transaction_id, quantity, day AS transaction_date FROM trade",
    "stg_exchange_rates": "SELECT day AS rate_date, rate AS exchange_rate FROM fx_latest",
    "dim_client": "SELECT * FROM client",
    "dim_currency": "SELECT * FROM currency",
    "fact_holdings": "SELECT *, rate_to_sar IS NULL OR value_sar IS NULL AS unvalued FROM holding",
    "fact_daily_portfolio_summary": "SELECT date_key FROM summary",
}


def _count(name: str, gate: str, columns: str, condition: str) -> str:
    return (
        f"SELECT '{name}' AS \"table\", '{gate}' AS gate, '{columns}' AS columns, "
        f"count(*) AS failures FROM ({_TABLE_SQL[name]}) AS t WHERE {condition}"
    )


def _repeats(name: str, column: str) -> str:
    return (
        f"SELECT '{name}' AS \"table\", 'unique' AS gate, '{column}' AS columns, count(*) AS failures "
        f"FROM (SELECT {column} FROM ({_TABLE_SQL[name]}) AS t WHERE {column} IS NOT NULL "
        f"GROUP BY {column} HAVING count(*) > 1) AS d"
    )


FAILED_GATES_SQL = with_blocks(
    "SELECT * FROM ("
    + "\nUNION ALL ".join(
        [
            *[
                _count("stg_precious_metals", "not_null", c, f"{c} IS NULL")
                for c in ["gold_usd", "silver_usd", "platinum_usd", "palladium_usd"]
            ],
            _count("stg_ledger_transactions", "not_null", "transaction_date", "transaction_date IS NULL"),
            _repeats("stg_ledger_transactions", "transaction_id"),
            _count("stg_exchange_rates", "accepted_range", "exchange_rate", "NOT exchange_rate > 0"),
            _repeats("dim_client", "client_key"),
            _repeats("dim_client", "client_id"),
            _count(
                "dim_currency",
                "accepted_values",
                "currency_code",
                "currency_code NOT IN ('CHF', 'EUR', 'GBP', 'SAR', 'USD')",
            ),
            _count("fact_holdings", "not_null", "date_key", "date_key IS NULL"),
            _repeats("fact_holdings", "holding_key"),
            _count("fact_holdings", "expression", "holdings_have_fx_rate", "unvalued"),
            _count("fact_daily_portfolio_summary", "not_null", "date_key", "date_key IS NULL"),
        ]
    )
    + ") AS g WHERE failures > 0"
)


@register("failed_gates", FAILED_GATES_SQL)
def failed_gates(spark: SparkSession, folder: str) -> DataFrame:
    """All 79 gates over the thirteen tables; the rows are the gates that fail."""
    galaxy = Galaxy(spark, folder)
    galaxy.keep_whole()
    for read_by_several_gates in ["fact_holdings", "fact_market_prices", "fact_daily_portfolio_summary"]:
        setattr(galaxy, read_by_several_gates, settle(getattr(galaxy, read_by_several_gates)))
    built = {name: getattr(galaxy, name) for name in gates.row_gates()}
    return gates.gate_report(built).where("failures > 0")


# ---- deliveries -----------------------------------------------------------------------------


@register(
    "exchange_rate_violations",
    with_blocks("""
    SELECT 'exchange_rates/' || day || '-' || status || '.json' AS file_name, 'not_success' AS rule,
           CAST(NULL AS VARCHAR) AS subject
    FROM (SELECT DISTINCT day, status FROM fx_quote) AS d WHERE status = 'P' AND quarter(day) = 4
    UNION ALL
    SELECT 'exchange_rates/' || d.day || '-' || d.status || '.json', 'missing_or_invalid_rate', s.code
    FROM (SELECT DISTINCT day, status FROM fx_quote) AS d
    CROSS JOIN (SELECT unnest(['USD', 'SAR', 'GBP', 'CHF']) AS code) AS s
    LEFT JOIN fx_quote AS q ON q.day = d.day AND q.status = d.status AND q.code = s.code
    WHERE NOT (d.status = 'P' AND quarter(d.day) = 4)
      AND (q.code IS NULL OR (s.code = 'CHF' AND day(d.day) = 13))"""),
)
def exchange_rate_violations(spark: SparkSession, folder: str) -> DataFrame:
    return payloads.rate_violations(fx_rates_raw(spark, folder), payloads.FX_SYMBOLS)


@register(
    "metal_price_violations",
    with_blocks("""
    SELECT 'metal_prices/' || day || '-' || status || '.json' AS file_name, 'not_success' AS rule,
           CAST(NULL AS VARCHAR) AS subject
    FROM metal_quote WHERE status = 'O' AND day(day) = 5
    UNION ALL
    SELECT 'metal_prices/' || day || '-' || status || '.json', 'missing_or_invalid_rate', symbol
    FROM (SELECT day, status, unnest(['USDXAU', 'USDXAG', 'USDXPT', 'USDXPD']) AS symbol,
                 unnest([xau, xag, xpt, xpd]) AS price FROM metal_quote) AS m
    WHERE price IS NULL AND NOT (status = 'O' AND day(day) = 5)"""),
)
def metal_price_violations(spark: SparkSession, folder: str) -> DataFrame:
    symbols = ["USDXAU", "USDXAG", "USDXPT", "USDXPD"]
    return payloads.rate_violations(metal_prices_raw(spark, folder), symbols)


@register(
    "equity_price_violations",
    with_blocks("""
    SELECT 'equity_prices/P' || l_partkey || '-' || l_linestatus || '.json' AS file_name, rule, subject
    FROM (SELECT DISTINCT l_partkey, l_linestatus FROM lineitem) AS f
    CROSS JOIN (VALUES ('missing_ticker', 'P3'), ('missing_ticker', 'AAPL'), ('no_series', 'Meta Data')) AS v(rule, subject)
    WHERE subject <> 'P' || l_partkey"""),
)
def equity_price_violations(spark: SparkSession, folder: str) -> DataFrame:
    return payloads.equity_violations(equity_prices_raw(spark, folder), ["P3", "AAPL"])


LEDGER_SQL = """
    SELECT 'T' || l_orderkey || '-' || l_linenumber AS transaction_id, unnest(list_filter([
        CASE WHEN s_nationkey IS NULL OR s_nationkey >= 20 THEN 'unknown_client' END,
        CASE WHEN s_nationkey < 20 AND l_suppkey % 50 = 7 AND l_linenumber = 7 THEN 'client_name_mismatch' END,
        CASE WHEN l_linenumber = 3 AND l_tax = 0.04 THEN 'missing_portfolio_id' END,
        CASE WHEN l_linenumber > 6 OR (l_linenumber = 3 AND l_tax = 0.04) THEN 'unknown_portfolio' END,
        CASE WHEN l_linenumber = 2 AND l_tax = 0.05 THEN 'unknown_type' END,
        CASE WHEN (l_linenumber = 6 AND l_tax = 0) OR (l_linenumber = 4 AND l_tax IN (0.02, 0.03, 0.06)) THEN 'total_mismatch' END,
        CASE WHEN l_linenumber > 3 AND p_type = 'ECONOMY' THEN 'unknown_ticker' END,
        CASE WHEN (l_linenumber <= 3 OR p_type <> 'ECONOMY') AND NOT (l_returnflag = 'A') THEN 'currency_mismatch' END,
        CASE WHEN (l_linenumber = 6 AND l_tax = 0) OR l_discount = 0 THEN 'not_positive' END],
        lambda x: x IS NOT NULL)) AS rule
    FROM lineitem LEFT JOIN supplier ON s_suppkey = l_suppkey LEFT JOIN part ON p_partkey = l_partkey"""


@register("ledger_violations", LEDGER_SQL)
def ledger_violations(spark: SparkSession, folder: str) -> DataFrame:
    """Ledger lines against a book of suppliers, parts and metals."""
    text = F.concat(F.lit("C"), F.col("s_suppkey").cast("string")).alias("client_id")
    name = F.concat(F.lit("Client "), F.col("s_suppkey").cast("string")).alias("client_name")
    parts = table(spark, folder, "part").where("p_type <> 'ECONOMY'")
    metals = spark.createDataFrame([("XAU",), ("XAG",), ("XPT",)], "ticker string")
    book = ledger.Book(
        clients=table(spark, folder, "supplier").where("s_nationkey < 20").select(text, name),
        portfolios=spark.createDataFrame([(f"P{i}",) for i in range(1, 7)], "portfolio_id string"),
        instruments=parts.select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("ticker"))
        .unionByName(metals)
        .withColumn("currency", F.lit("USD")),
    )
    line, tax = F.substring_index("transaction_id", "-", -1).cast("int"), F.col("l_tax")
    wrong = {0.02: F.lit("abc"), 0.03: F.lit("999999999999999.00"), 0.06: F.concat("total", F.lit("1"))}
    total = F.col("total")
    for value, text in wrong.items():
        total = F.when((line == 4) & (tax == value), text).otherwise(total)
    faults = {
        "total": total,
        "portfolio_id": F.when((line == 3) & (tax == 0.04), "").otherwise(F.col("portfolio_id")),
        "transaction_type": F.when((line == 2) & (tax == 0.05), "GIFT").otherwise(F.col("transaction_type")),
    }
    lines = ledger_lines(spark, folder, "l_tax").withColumns(faults).withColumn("file_name", F.lit("ledger.csv"))
    return ledger.ledger_violations(lines, book).drop("file_name")


@register(
    "ledger_row_counts",
    """
    SELECT d.day AS file_name, d.expected, coalesce(l.found, 0) AS found
    FROM (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, count(*) AS expected FROM orders GROUP BY ALL) AS d
    LEFT JOIN (SELECT strftime(l_shipdate, '%Y-%m-%d') AS day, count(*) AS found FROM lineitem GROUP BY ALL) AS l
      ON l.day = d.day
    WHERE d.expected <> coalesce(l.found, 0)""",
)
def ledger_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Daily batches against the number of rows announced for them."""
    announced = table(spark, folder, "orders").groupBy(F.date_format("o_orderdate", "yyyy-MM-dd").alias("file_name"))
    lines = table(spark, folder, "lineitem").select(F.date_format("l_shipdate", "yyyy-MM-dd").alias("file_name"))
    return ledger.row_count_violations(lines, announced.agg(F.count(F.lit(1)).alias("rows")))
