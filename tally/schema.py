"""Common schema and per-source specifications."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Raw table contract shared by both sources (typed, standardised).
RAW_SCHEMA = T.StructType([
    T.StructField("transaction_id", T.StringType()),
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("description", T.StringType()),
    T.StructField("amount", T.DoubleType()),
    T.StructField("transaction_type", T.StringType()),
    T.StructField("source", T.StringType()),
])
COMMON_COLUMNS = [f.name for f in RAW_SCHEMA.fields]

# Allowed transaction types and the quality-check bounds.
VALID_TRANSACTION_TYPES = ("credit", "debit")
AMOUNT_MIN = -50_000.00
AMOUNT_MAX = 50_000.00
ROW_COUNT_MIN = 1
ROW_COUNT_MAX = 100_000

DEFAULT_START_DATE = "2024-01-01"


@dataclass(frozen=True)
class SourceSpec:
    """Everything that differs between the two exports."""

    name: str
    column_map: dict[str, str]          # file column -> common column
    required: tuple[str, ...]           # must be present in the file
    non_nullable: tuple[str, ...]       # checked for nulls, in this order
    id_column: str = "transaction_id"
    date_column: str = "date"
    amount_column: str = "amount"
    type_column: str = "transaction_type"
    raw_table: str = ""


# File column names of each export and their common names.
BANK = SourceSpec(
    name="bank",
    column_map={
        "transaction_id": "transaction_id",
        "date": "date",
        "description": "description",
        "amount": "amount",
        "transaction_type": "transaction_type",
    },
    required=("transaction_id", "date", "description", "amount", "transaction_type"),
    non_nullable=("transaction_id", "date", "description", "amount", "transaction_type"),
    date_column="date",
    raw_table="raw_bank_transactions",
)

CARD = SourceSpec(
    name="card",
    column_map={
        "transaction_id": "transaction_id",
        "post_date": "date",
        "merchant_name": "description",
        "amount": "amount",
        "transaction_type": "transaction_type",
    },
    required=("transaction_id", "post_date", "merchant_name", "amount", "transaction_type"),
    non_nullable=("transaction_id", "post_date", "merchant_name", "amount", "transaction_type"),
    date_column="post_date",
    raw_table="raw_card_transactions",
)

# The provider's own category, a further column of the card export that a
# load can carry into the raw table.
PROVIDER_COLUMN = {"merchant_category": "provider_category"}

SOURCES = {"bank": BANK, "card": CARD}
