"""Checks of delivered ledger batches, before they are loaded."""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from halala.functions.amounts import exact_product
from halala.operators.lookup import attach
from halala.quality.gates import SIDES
from halala.schemas import LEDGER_FILE_COLUMNS

HALF_CENT = Decimal("0.005")


@dataclass(frozen=True)
class Book:
    """What a ledger may refer to; each table is unique on its first column."""

    clients: DataFrame  # client_id, client_name
    portfolios: DataFrame  # portfolio_id
    instruments: DataFrame  # ticker, currency


def _differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def _names(broken: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(condition, F.lit(name)) for name, condition in broken.items()]))


def ledger_violations(lines: DataFrame, book: Book) -> DataFrame:
    """One row per broken rule of a ledger line (all file columns as text, plus `file_name`)."""
    known = F.lit(True)
    clients = book.clients.toDF("_client", "_name").withColumn("_known_client", known)
    portfolios = book.portfolios.toDF("_portfolio").withColumn("_known_portfolio", known)
    instruments = book.instruments.toDF("_ticker", "_currency").withColumn("_known_ticker", known)
    rows = lines.select("file_name", *LEDGER_FILE_COLUMNS)
    rows = attach(rows, clients, "client_id", "_client", ["_name", "_known_client"])
    rows = attach(rows, portfolios, "portfolio_id", "_portfolio", ["_known_portfolio"])

    amount = {c: F.col(c).try_cast("decimal(38,4)") for c in ["quantity", "price", "fee_amount"]}
    delivered = F.col("total").try_cast("decimal(38,8)")
    gross = exact_product(amount["quantity"], amount["price"], strict=False)
    side = F.col("transaction_type")
    total = F.when(side == "BUY", gross + amount["fee_amount"]).when(side == "SELL", amount["fee_amount"] - gross)
    # A total that does not parse, cannot be computed or has parts of a cent does not match.
    matches = (F.abs(total - delivered) <= HALF_CENT) & (delivered == F.round(delivered, 2))

    def not_positive(column: str) -> Column:
        number = F.col(column).try_cast("double")
        return ~F.coalesce((number > 0) & ~F.isnan(number), F.lit(False))

    broken = {
        **{f"missing_{c}": F.coalesce(F.col(c), F.lit("")) == "" for c in LEDGER_FILE_COLUMNS},
        "unknown_client": F.col("_known_client").isNull(),
        "client_name_mismatch": F.col("_known_client").isNotNull() & _differs(F.col("client_name"), F.col("_name")),
        "unknown_portfolio": F.col("_known_portfolio").isNull(),
        "unknown_type": ~F.coalesce(F.col("transaction_type").isin(SIDES), F.lit(False)),
        "not_positive": not_positive("quantity") | not_positive("price") | not_positive("fee_amount"),
        "total_mismatch": F.coalesce(side.isin(SIDES), F.lit(False)) & ~F.coalesce(matches, F.lit(False)),
    }
    # instruments may be too many to broadcast, so what meets them is narrow: a line's other broken rules, mostly none
    rows = rows.select("file_name", "transaction_id", "ticker", "currency", _names(broken).alias("_rules"))
    rows = attach(rows, instruments, "ticker", "_ticker", ["_currency", "_known_ticker"])
    broken = {
        "unknown_ticker": F.col("_known_ticker").isNull(),
        "currency_mismatch": F.col("_known_ticker").isNotNull() & _differs(F.col("currency"), F.col("_currency")),
    }
    return rows.select("file_name", "transaction_id", F.explode(F.concat("_rules", _names(broken))).alias("rule"))


def row_count_violations(lines: DataFrame, expected: DataFrame) -> DataFrame:
    """Files whose rows differ from `expected` (file_name, rows); a file may be missing entirely."""
    counted = lines.groupBy("file_name").agg(F.count(F.lit(1)).alias("found"))
    compared = expected.join(counted, "file_name", "left").fillna(0, ["found"])
    return compared.where("rows <> found").select("file_name", F.col("rows").alias("expected"), "found")
