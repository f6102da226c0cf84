"""Schemas of the RAW layer and of the delivered files."""

from __future__ import annotations

from pyspark.sql import types as T

# The header of a ledger batch file, in file order.
LEDGER_FILE_COLUMNS = [
    "transaction_id",
    "client_id",
    "client_name",
    "portfolio_id",
    "ticker",
    "transaction_type",
    "quantity",
    "price",
    "currency",
    "fee_amount",
    "transaction_date",
    "transaction_ts",
    "total",
]

# `total` can be derived from the other columns and is not kept.
LEDGER_KEPT_COLUMNS = [c for c in LEDGER_FILE_COLUMNS if c != "total"]

LEDGER_FILE = T.StructType([T.StructField(c, T.StringType()) for c in LEDGER_FILE_COLUMNS])

RAW_DOCUMENT = T.StructType(
    [
        T.StructField("raw", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)

RAW_LEDGER = T.StructType(
    [T.StructField(c, T.StringType()) for c in LEDGER_KEPT_COLUMNS]
    + [
        T.StructField("batch_id", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("_loaded_at", T.TimestampType()),
    ]
)

# Landing folder of each feed and the RAW table it fills.
DOCUMENT_FEEDS = {
    "exchange_rates": "fx_rates_raw",
    "metal_prices": "metal_prices_raw",
    "equity_prices": "equity_prices_raw",
}
LEDGER_FEED = ("internal_ledger", "ledger_transactions_raw")
