"""The unified ledger: union of both sources, ids, calendar, flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tally.functions.calendar import calendar_columns
from tally.functions.text import contains_any

UNION_COLUMNS = [
    "transaction_id", "transaction_date", "description", "amount", "is_debit",
    "absolute_amount", "transaction_type", "provider_category", "source", "_loaded_at",
]

# Description fragments that mark payments and transfers.
PAYMENT_KEYWORDS = ["PAYMENT"]
TRANSFER_KEYWORDS = ["TRANSFER", "ZELLE", "VENMO"]


def union_ledger(bank: DataFrame, card: DataFrame) -> DataFrame:
    """UNION ALL of the staged sources; the bank side gets a typed NULL category."""
    if "provider_category" not in bank.columns:
        bank = bank.withColumn("provider_category", F.lit(None).cast("string"))
    return bank.select(*UNION_COLUMNS).unionByName(card.select(*UNION_COLUMNS))


def payment_flag(source: Column, ttype: Column, description: Column) -> Column:
    """Card credits whose text mentions a payment (bank rows never are)."""
    return F.coalesce((source == "card") & (ttype == "credit")
                      & contains_any(description, PAYMENT_KEYWORDS), F.lit(False))


def transfer_flag(description: Column) -> Column:
    """Transfers between own accounts or to people, from either source."""
    return F.coalesce(contains_any(description, TRANSFER_KEYWORDS), F.lit(False))


def enrich(unioned: DataFrame) -> DataFrame:
    """Add the global id, calendar columns and the payment/transfer flags.

    ``description`` is upper case after staging, so keyword tests are plain
    ``contains`` (equal to ``ilike '%kw%'``) and stay in generated code.
    """
    cal = calendar_columns("transaction_date")
    d = F.col("description")
    return unioned.select(
        F.concat(F.col("source"), F.lit("-"), F.col("transaction_id")).alias("unique_transaction_id"),
        "transaction_id", "transaction_date", "description", "provider_category",
        "amount", "is_debit", "absolute_amount", "transaction_type", "source",
        *[c.alias(n) for n, c in cal.items()],
        payment_flag(F.col("source"), F.col("transaction_type"), d).alias("is_payment"),
        transfer_flag(d).alias("is_transfer"),
        "_loaded_at",
    )
