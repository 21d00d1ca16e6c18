"""A corpus pipeline of five stages over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before
it kept, and returns a DataFrame that is written as Parquet and read again as
the next stage's docs. All but the last return the columns of ``documents``.

1. toxicity: rows that the lexicon classifier rejects go;
2. exact dedup: one row of each set of equal texts stays;
3. n-gram Jaccard join: one row of each near-duplicate component stays;
4. secret scans: every secret found is replaced by a marker, all rows stay;
5. packing: the texts become sequences of 4096 ids along a Hilbert curve, one
   row per piece with its ids.

A stage's null, empty, long or repeated rows are treated as its operator says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tally.llm import exact_dedup, jaccard_join, packing, secrets, toxicity
from tally.llm.common import materialise, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.toxicity_model(spark, docs, sf_dir))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The toxicity stage fits a model and the secret scan decodes layers, so SQL cannot express the rows.
ORACLE_SQL = None
