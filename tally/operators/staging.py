"""Typed staging of the two raw tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STAGING_COLUMNS = [
    "transaction_id", "transaction_date", "description", "amount", "is_debit",
    "absolute_amount", "transaction_type", "source", "_loaded_at",
]


def usable(df: DataFrame) -> DataFrame:
    """Rows that downstream joins and aggregates can use."""
    return df.filter(F.col("transaction_id").isNotNull()
                     & F.col("transaction_date").isNotNull()
                     & F.col("amount").isNotNull())


def stg_bank(raw: DataFrame) -> DataFrame:
    """Bank staging: debits are negative in the file and stay negative."""
    amount = F.col("amount").cast("double")
    return usable(raw.select(
        F.col("transaction_id"),
        F.col("date").cast("date").alias("transaction_date"),
        F.upper(F.trim(F.col("description"))).alias("description"),
        amount.alias("amount"),
        F.coalesce(amount < 0, F.lit(False)).alias("is_debit"),
        F.abs(amount).alias("absolute_amount"),
        F.lower(F.trim(F.col("transaction_type"))).alias("transaction_type"),
        F.lit("bank").alias("source"),
        F.current_timestamp().alias("_loaded_at"),
    ))


def stg_card(raw: DataFrame, carry_provider_category: bool = False) -> DataFrame:
    """Card staging: purchases are positive in the file, so the sign flips.

    ``is_debit`` tests the unflipped amount. The provider's merchant category
    is NULL unless ``carry_provider_category`` is set and the raw table holds
    a ``provider_category`` column.
    """
    amount = F.col("amount").cast("double")
    if carry_provider_category and "provider_category" in raw.columns:
        provider = F.col("provider_category").cast("string")
    else:
        provider = F.lit(None).cast("string")
    return usable(raw.select(
        F.col("transaction_id"),
        F.col("date").cast("date").alias("transaction_date"),
        F.upper(F.trim(F.col("description"))).alias("description"),
        provider.alias("provider_category"),
        (amount * F.lit(-1)).alias("amount"),
        F.coalesce(amount > 0, F.lit(False)).alias("is_debit"),
        F.abs(amount).alias("absolute_amount"),
        F.lower(F.trim(F.col("transaction_type"))).alias("transaction_type"),
        F.lit("card").alias("source"),
        F.current_timestamp().alias("_loaded_at"),
    ))
