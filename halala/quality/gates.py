"""Data-quality gates: each yields one row with the number of violations it found."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halala.functions.keys import packed
from halala.operators.reshape import stack_rows


class GateFailure(Exception):
    """Raised with the failed gates after a build step."""


@dataclass(frozen=True)
class RowGate:
    """A rule that each row meets or breaks."""

    kind: str
    column: str
    broken: Column = field(compare=False)


def not_null(*columns: str) -> list[RowGate]:
    return [RowGate("not_null", c, F.col(c).isNull()) for c in columns]


def accepted_values(column: str, values: Sequence[str]) -> list[RowGate]:
    """NULL passes."""
    return [RowGate("accepted_values", column, ~F.col(column).isin(list(values)))]


def above(column: str, bound: float) -> list[RowGate]:
    """Greater than the bound; NULL passes."""
    return [RowGate("accepted_range", column, ~(F.col(column) > bound))]


def expression(name: str, broken: Column) -> list[RowGate]:
    return [RowGate("expression", name, broken)]


def _report(counts: DataFrame, table: str, kind: str, columns: str) -> DataFrame:
    return counts.select(
        F.lit(table).alias("table"), F.lit(kind).alias("gate"), F.lit(columns).alias("columns"), "failures"
    )


def check_rows(df: DataFrame, table: str, gates: Sequence[RowGate]) -> DataFrame:
    """All row gates of a table in one pass over it."""
    counts = df.agg(*[F.count(F.when(g.broken, 1)).alias(f"g{i}") for i, g in enumerate(gates)])
    entries = [
        F.struct(
            F.lit(table).alias("table"),
            F.lit(g.kind).alias("gate"),
            F.lit(g.column).alias("columns"),
            F.col(f"g{i}").alias("failures"),
        )
        for i, g in enumerate(gates)
    ]
    return counts.select(F.inline(F.array(*entries)))


def check_unique(df: DataFrame, table: str, *columns: str) -> DataFrame:
    """Number of values (or combinations) that occur more than once.

    NULL is ignored for a single column; a combination counts it as a value.
    """
    # only counted, so texts may be moved packed
    rows = df.select(*[packed(c).alias(c) if df.schema[c].dataType.typeName() == "string" else c for c in columns])
    if len(columns) == 1:
        rows = rows.dropna()
    repeated = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_copies")).where("_copies > 1")
    kind = "unique" if len(columns) == 1 else "unique_combination"
    return _report(repeated.agg(F.count(F.lit(1)).alias("failures")), table, kind, ", ".join(columns))


def check_relationship(child: DataFrame, table: str, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Number of rows whose key is missing in the parent; NULL passes.

    Both sides are reduced to their distinct keys before the join, so no key is hot in it.
    """
    keys = child.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("_key"))
    keys = keys.agg(F.count(F.lit(1)).alias("_rows"))
    known = parent.select(F.col(parent_column).alias("_key")).distinct()
    orphans = keys.join(known, "_key", "left_anti")
    total = orphans.agg(F.coalesce(F.sum("_rows"), F.lit(0)).alias("failures"))
    return _report(total, table, "relationships", column)


def check_relationships(child: DataFrame, table: str, keys: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """The same for several keys of a table at once: column to parent and its column, in one pass over the rows."""
    named = [F.struct(F.lit(c).alias("_column"), F.col(c).cast("string").alias("_key")) for c in keys]
    held = child.select(F.inline(F.array(*named))).where(F.col("_key").isNotNull())
    counted = held.groupBy("_column", "_key").agg(F.count(F.lit(1)).alias("_rows"))
    known = [p.select(F.lit(c).alias("_column"), F.col(of).cast("string").alias("_key")) for c, (p, of) in keys.items()]
    orphans = counted.join(stack_rows(*known).distinct(), ["_column", "_key"], "left_anti")
    total = orphans.groupBy("_column").agg(F.sum("_rows").alias("failures"))
    columns = child.sparkSession.createDataFrame([(c,) for c in keys], "_column string")
    return columns.join(total, "_column", "left").select(
        F.lit(table).alias("table"),
        F.lit("relationships").alias("gate"),
        F.col("_column").alias("columns"),
        F.coalesce("failures", F.lit(0)).alias("failures"),
    )


def enforce(report: DataFrame) -> None:
    """Raise when a gate found violations; a report has one row per gate."""
    failed = report.where("failures > 0").orderBy("table", "gate", "columns").collect()
    if failed:
        lines = [f"{r['table']}: {r['gate']}({r['columns']}) failed {r['failures']} times" for r in failed]
        raise GateFailure("\n".join(lines))


# Accepted codes.
BASES = ["USD", "EUR"]
SIDES = ["BUY", "SELL"]
ASSET_TYPES = ["EQUITY", "ETF", "METAL"]
CURRENCIES = ["CHF", "EUR", "GBP", "SAR", "USD"]
SOURCE_TYPES = ["External", "Internal"]
SAR_TOLERANCE = 0.000001

# Unique columns and combinations per table.
UNIQUE = {
    "stg_precious_metals": [("api_timestamp",)],
    "stg_equity_prices": [("ticker", "date")],
    "stg_exchange_rates": [("rate_date", "base_currency", "target_currency")],
    "stg_ledger_transactions": [("transaction_id",)],
    "dim_asset": [("asset_key",), ("ticker",)],
    "dim_client": [("client_key",), ("client_id",)],
    "dim_currency": [("currency_key",)],
    "dim_date": [("date_key",)],
    "dim_source": [("source_key",)],
    "fact_holdings": [("holding_key",)],
    "fact_market_prices": [("market_price_key",)],
    "fact_daily_portfolio_summary": [("portfolio_summary_key",)],
}

# Dimension that each foreign key points to; the key has the same name on both sides.
FOREIGN_KEYS = {
    "fact_holdings": {
        "date_key": "dim_date",
        "asset_key": "dim_asset",
        "client_key": "dim_client",
        "currency_key": "dim_currency",
    },
    "fact_market_prices": {
        "date_key": "dim_date",
        "asset_key": "dim_asset",
        "currency_key": "dim_currency",
        "source_key": "dim_source",
    },
    "fact_daily_portfolio_summary": {"date_key": "dim_date", "client_key": "dim_client"},
}


def row_gates() -> dict[str, list[RowGate]]:
    """Column rules per table."""
    delivery = ["file_name", "loaded_at"]
    metal_columns = ["gold_usd", "silver_usd", "platinum_usd", "palladium_usd"]
    price_columns = ["open_price", "high_price", "low_price", "close_price", "volume"]
    not_one = F.abs(F.col("rate_to_sar") - 1) > SAR_TOLERANCE
    unvalued = F.col("exchange_rate").isNull() | F.col("value_sar").isNull()
    return {
        "stg_precious_metals": [
            *not_null("success", "base_currency", "api_timestamp", *metal_columns, *delivery),
            *accepted_values("base_currency", ["USD"]),
        ],
        "stg_equity_prices": [
            *not_null("ticker", "date", *price_columns, *delivery),
            *above("close_price", 0),
        ],
        "stg_exchange_rates": [
            *not_null("rate_date", "exchange_rate"),
            *accepted_values("base_currency", BASES),
            *above("exchange_rate", 0),
        ],
        "stg_ledger_transactions": [
            *not_null("transaction_id", "quantity", "transaction_date"),
            *accepted_values("transaction_type", SIDES),
            *above("quantity", 0),
        ],
        "int_fx_rates_to_sar": expression("sar_rate_is_one", (F.col("currency_code") == "SAR") & not_one),
        "dim_asset": [*not_null("asset_key", "ticker"), *accepted_values("asset_type", ASSET_TYPES)],
        "dim_client": not_null("client_key", "client_id"),
        "dim_currency": [*not_null("currency_key"), *accepted_values("currency_code", CURRENCIES)],
        "dim_date": not_null("date_key"),
        "dim_source": [*not_null("source_key"), *accepted_values("source_type", SOURCE_TYPES)],
        "fact_holdings": [
            *not_null("holding_key", "date_key", "asset_key", "client_key", "currency_key"),
            *accepted_values("transaction_type", SIDES),
            *expression("holdings_have_fx_rate", unvalued),
        ],
        "fact_market_prices": not_null("market_price_key", "date_key", "asset_key", "currency_key", "source_key"),
        "fact_daily_portfolio_summary": not_null("portfolio_summary_key", "date_key", "client_key"),
    }


def gate_report(tables: Mapping[str, DataFrame], parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Every gate of the given tables; `parents` are the dimensions their keys point to."""
    parents = parents if parents is not None else tables
    rules = row_gates()
    parts = []
    for name, df in tables.items():
        if name in rules:
            parts.append(check_rows(df, name, rules[name]))
        parts += [check_unique(df, name, *columns) for columns in UNIQUE.get(name, [])]
        keys = {key: (parents[parent], key) for key, parent in FOREIGN_KEYS.get(name, {}).items()}
        if keys:
            parts.append(check_relationships(df, name, keys))
    return stack_rows(*parts)
