"""The model graph: raw tables -> staging -> ledger -> categorised -> marts.

Each model is a function from DataFrames to a DataFrame; nothing runs until
an action, so Catalyst sees the whole chain (filters and column pruning
reach the raw scans). ``build_marts`` materialises all four marts and
reuses the categorised ledger across them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from tally.operators.ledger import enrich, union_ledger
from tally.operators.rules import Rule, categorize
from tally.operators.staging import stg_bank, stg_card
from tally.plans import marts
from tally.schema import BANK, CARD, DEFAULT_START_DATE
from tally.sources.adapter import bank_export, card_export
from tally.sources.files import map_to_common
from tally.sources.raw import standardise


@dataclass(frozen=True)
class ModelOptions:
    start_date: str = DEFAULT_START_DATE
    carry_provider_category: bool = False
    rules: Sequence[Rule] | None = None


def int_all_transactions(raw_bank: DataFrame, raw_card: DataFrame,
                         opts: ModelOptions = ModelOptions()) -> DataFrame:
    return enrich(union_ledger(stg_bank(raw_bank),
                               stg_card(raw_card, opts.carry_provider_category)))


def int_categorized(raw_bank: DataFrame, raw_card: DataFrame,
                    opts: ModelOptions = ModelOptions()) -> DataFrame:
    return categorize(int_all_transactions(raw_bank, raw_card, opts), opts.rules)


def register_views(raw_bank: DataFrame, raw_card: DataFrame,
                   opts: ModelOptions = ModelOptions()) -> dict[str, DataFrame]:
    """Expose the staging and intermediate models as temporary views under
    their model names, for SQL users. Views hold no data: each query that
    reads one recomputes it, as the reference's view layer does."""
    bank, card = stg_bank(raw_bank), stg_card(raw_card, opts.carry_provider_category)
    models = {
        "stg_bank_txns": bank,
        "stg_card_txns": card,
        "int_all_transactions": int_all_transactions(raw_bank, raw_card, opts),
        "int_categorized": int_categorized(raw_bank, raw_card, opts),
    }
    for name, df in models.items():
        df.createOrReplaceTempView(name)
    return models


def build_marts(raw_bank: DataFrame, raw_card: DataFrame,
                opts: ModelOptions = ModelOptions()) -> dict[str, DataFrame]:
    """All four marts from one pass over the categorised ledger.

    The ledger is reduced once to ``marts.ledger_rollup`` (one row per month,
    category, income type, source and filter flags), which is small whatever
    the data volume; that roll-up is persisted and every mart re-aggregates
    it. The raw tables are therefore scanned once for all marts and nothing
    of ledger size is cached. Callers write the marts and then call
    ``unpersist`` on ``result['_rollup']``.
    """
    rollup = marts.ledger_rollup(int_categorized(raw_bank, raw_card, opts), opts.start_date)
    rollup = rollup.persist(StorageLevel.MEMORY_AND_DISK)
    out = marts.marts_from_rollup(rollup, opts.start_date)
    out["_rollup"] = rollup
    return out


# --------------------------------------------------------------------------
# raw tables derived from the driver's tables (see sources.adapter)
# --------------------------------------------------------------------------

def raw_bank_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standardise(map_to_common(bank_export(spark, sf_dir), BANK))


def raw_card_from_tables(spark: SparkSession, sf_dir: str,
                         with_category: bool = False) -> DataFrame:
    export = card_export(spark, sf_dir, with_category)
    carry = {"merchant_category": "provider_category"} if with_category else None
    return standardise(map_to_common(export, CARD, carry))
