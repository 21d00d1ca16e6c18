"""Derive bank and card exports from the driver's TPC-H-style tables.

The bank export comes from ``orders`` and the card export from
``lineitem`` (joined to ``part`` only when the merchant category is asked
for). The derivation is row-wise, so it scales with the tables and adds no
shuffle except that optional join.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Bank descriptions picked by o_orderkey % 20 (0-based).
BANK_DESCRIPTIONS = [
    "DIRECT DEPOSIT - EMPLOYER PAYROLL",
    "WALMART SUPERCENTER #4821",
    "NETFLIX.COM",
    "SHELL OIL 57442",
    "CHIPOTLE MEXICAN GRILL",
    "ATM WITHDRAWAL - MAIN ST BRANCH",
    "FLORIDA POWER & LIGHT",
    "KROGER #0342",
    "TAX REFUND",
    "TRANSFER TO SAVINGS",
    "ZELLE TO LANDLORD",
    "DIRECT DEPOSIT - BONUS",
    "COMCAST CABLE",
    "GOLD'S GYM",
    "UBER *TRIP",
    "VENMO PAYMENT RECEIVED",
    "CASHAPP CASH OUT",
    "COSTCO WHSE #0842",
    "PROGRESSIVE INSURANCE",
    "INTEREST PAYMENT",
]
# Bank list positions that are credits (paid in at 5x).
BANK_CREDIT_INDEXES = [0, 8, 11, 15, 16, 19]

# Card merchants picked by l_partkey % 16 (0-based).
CARD_MERCHANTS = [
    "mcdonald's #3847",
    "amazon.com",
    "amazon prime video",
    "  uber eats  ",
    "Uber *Trip",
    "adobe inc",
    "cvs pharmacy #8812",
    "delta air lines",
    "coffee house",
    "apple.com/bill",
    "payment received - thank you",
    "home depot #0451",
    "foreign transaction fee",
    "best buy 00031",
    "merchant return",
    "card rewards",
]
# Card list positions that are credits (negative in the file).
CARD_CREDIT_INDEXES = [10, 14, 15]
CARD_CREDIT_TYPE = " Credit"
CARD_DEBIT_TYPE = "DEBIT "


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def _with_fraction(price: Column, ten_thousandths: Column) -> Column:
    """A price with a third and fourth decimal place, exact."""
    fraction = ten_thousandths.cast("decimal(18,4)") * F.lit("0.0001").cast("decimal(5,4)")
    return (price.cast("decimal(18,2)") + fraction).cast("decimal(18,4)")


def bank_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bank export in file form: the five columns a bank CSV carries.

    ``amount`` is DECIMAL(18,4) (exact, written as plain text in CSV; the
    third and fourth place come from the key) and ``date`` a DATE; a reader
    treats both as text, as with a real file.
    """
    o = _table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_totalprice")
    idx = F.col("o_orderkey") % 20
    credit = idx.isin(BANK_CREDIT_INDEXES)
    price = _with_fraction(F.col("o_totalprice"), F.col("o_orderkey") % 97)
    return o.select(
        F.concat(F.lit("O"), F.col("o_orderkey").cast("string")).alias("transaction_id"),
        F.col("o_orderdate").cast("date").alias("date"),
        _pick(BANK_DESCRIPTIONS, idx).alias("description"),
        F.when(credit, price * F.lit(5)).otherwise(-price).cast("decimal(18,4)").alias("amount"),
        F.when(credit, F.lit("credit")).otherwise(F.lit("debit")).alias("transaction_type"),
    )


def card_export(spark: SparkSession, sf_dir: str, with_category: bool = False) -> DataFrame:
    """Card export in file form (purchases positive, as card exports are).

    With ``with_category`` the export also carries ``merchant_category``
    from ``part``; that needs a join on the part key, which is left to the
    planner (sort-merge or broadcast by runtime size under AQE).
    """
    cols = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate"]
    li = _table(spark, sf_dir, "lineitem").select(*cols)
    idx = F.col("l_partkey") % 16
    credit = idx.isin(CARD_CREDIT_INDEXES)
    price = _with_fraction(F.col("l_extendedprice"), F.col("l_orderkey") % 89)
    out = [
        F.concat(F.lit("L"), F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_partkey").cast("string"), F.lit("-"),
                 F.col("l_suppkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.col("l_shipdate").cast("date").alias("post_date"),
        _pick(CARD_MERCHANTS, idx).alias("merchant_name"),
    ]
    if with_category:
        part = _table(spark, sf_dir, "part").select("p_partkey", "p_type")
        li = li.join(part, li.l_partkey == part.p_partkey, "inner")
        out.append(F.nullif(F.col("p_type"), F.lit("STANDARD")).alias("merchant_category"))
    out += [
        F.when(credit, -price).otherwise(price).cast("decimal(18,4)").alias("amount"),
        F.when(credit, F.lit(CARD_CREDIT_TYPE)).otherwise(F.lit(CARD_DEBIT_TYPE)).alias("transaction_type"),
    ]
    return li.select(*out)


def card_export_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card export with defects for the quality checks, all columns text.

    Ids repeat (order key and line number only), some amounts and dates do
    not parse, and many amounts fall outside the expected bounds.
    """
    li = _table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_extendedprice", "l_shipdate")
    idx = F.col("l_partkey") % 16
    credit = idx.isin(CARD_CREDIT_INDEXES)
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    amount_text = F.when(credit, -price).otherwise(price).cast("decimal(18,2)").cast("string")
    k = F.col("l_orderkey")
    return li.select(
        F.concat(F.lit("L"), k.cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("transaction_id"),
        F.when(k % 101 == 0, F.lit("not a date"))
         .otherwise(F.col("l_shipdate").cast("date").cast("string")).alias("post_date"),
        _pick(CARD_MERCHANTS, idx).alias("merchant_name"),
        F.when(k % 97 == 0, F.lit("n/a")).when(k % 89 == 0, F.lit(""))
         .otherwise(amount_text).alias("amount"),
        F.when(credit, F.lit(CARD_CREDIT_TYPE)).otherwise(F.lit(CARD_DEBIT_TYPE)).alias("transaction_type"),
    )
