"""Operator 6: exact dedup with static binary-fuse filters per snapshot.

The snapshot is immutable. Its digests fall into buckets by hash, each with
one fuse filter over its distinct digests. A new batch is screened bucket by
bucket: a digest that its filter rules out is new for certain; the others
join the snapshot's exact buckets on the whole digest. Duplicates inside the
new batch are grouped on their own. Every digest that has more than one row
is then checked byte by byte: its rows' texts are grouped as texts, and two
texts under one digest stop the job.

Only digests cross the network for the screen, one row per distinct digest
(rows are pre-aggregated before each shuffle), and texts only where a digest
repeats, once per digest and task.

Defined cases: null text is the empty text, and empty texts equal each other.
A null id belongs to its group but never stays while another id is there;
a group of null ids alone has a null keep_id and its rows count as kept.
Rows that repeat an id and its text are members like any other, and all
rows with the staying id are marked kept (``drop_copies`` leaves one).
Empty tables give empty results. Columns other than id and text are ignored.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm import fuse
from tally.llm.common import crc_bucket, fresh_name, id_and_text, materialise, table

#: Distinct digests aimed at in a bucket; the number of buckets grows with the table.
BUCKET_KEYS = 50_000

FILTER_SCHEMA = "bucket long, seed string, seg int, segments int, marks binary"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, digest (SHA-256 of the whole text, binary)."""
    return docs.select("doc_id", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"))


def _distinct(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))


def _keyed(rows: DataFrame, buckets: int) -> DataFrame:
    key = F.xxhash64("digest")
    return rows.withColumn("key", key).withColumn("bucket", F.pmod(key, F.lit(buckets)))


def build_filters(snapshot: DataFrame, buckets: int) -> DataFrame:
    """One fuse filter per bucket over the distinct digests of a snapshot."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, seg, count, marks = fuse.build(pdf["key"].to_numpy())
        return pd.DataFrame([(pdf["bucket"].iloc[0], str(seed), seg, count, marks)],
                            columns=["bucket", "seed", "seg", "segments", "marks"])
    return _keyed(snapshot, buckets).select("bucket", "key").groupBy("bucket").applyInPandas(build, FILTER_SCHEMA)


def screen(incoming: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Distinct incoming digests with ``maybe``: false is certainly not in the snapshot."""
    def ask(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if len(right) and len(left):
            f = right.iloc[0]
            maybe = fuse.contains(left["key"].to_numpy(), int(f["seed"]), int(f["seg"]), int(f["segments"]),
                                  f["marks"])
        else:
            maybe = [False] * len(left)
        return left[["digest", "last", "n"]].assign(maybe=maybe)
    keyed = _keyed(incoming, buckets)
    last = incoming.schema["last"].dataType.simpleString()
    return (keyed.groupBy("bucket").cogroup(filters.groupBy("bucket"))
            .applyInPandas(ask, f"digest binary, last {last}, n long, maybe boolean"))


def digest_groups(snapshot: DataFrame, incoming: DataFrame) -> DataFrame:
    """All distinct digests of both sides with their largest id and row count.

    ``snapshot`` and ``incoming`` are (doc_id, digest) rows.
    """
    old = materialise(_distinct(snapshot), "snapshot-digests")
    new = materialise(_distinct(incoming), "incoming-digests")
    buckets = max(1, -(-max(old.count(), new.count()) // BUCKET_KEYS))
    filters = materialise(build_filters(old, buckets), "fuse-filters")
    screened = materialise(screen(new, filters, buckets), "screened")
    maybe = screened.filter("maybe").drop("maybe")
    hit = (maybe.join(old.select("digest", F.col("last").alias("o_last"), F.col("n").alias("o_n")), "digest", "left"))
    seen = hit.select("digest", F.greatest("last", "o_last").alias("last"),
                      (F.col("n") + F.coalesce("o_n", F.lit(0))).alias("n"))
    rest = old.join(maybe.select("digest"), "digest", "left_anti")
    return screened.filter("not maybe").drop("maybe").unionByName(seen).unionByName(rest)


def byte_groups(docs: DataFrame, repeated: DataFrame, spread: int = 16) -> DataFrame:
    """digest, keep_id, group_size of every repeated digest, texts compared byte by byte.

    A hot digest's rows are spread over ``spread`` join keys; equal texts
    meet once per task in the second, pre-aggregated shuffle.
    """
    rows = docs.select("doc_id", "text", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest"),
                       F.pmod(F.xxhash64("doc_id"), F.lit(spread)).alias("salt"))
    wanted = repeated.select("digest", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(spread - 1).cast("long"))).alias("salt"))
    texts = (rows.join(wanted, ["digest", "salt"], "left_semi")
             .groupBy("digest", "text").agg(F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n")))
    one = F.when(F.count(F.lit(1)) == 1, F.max("n")).otherwise(
        F.raise_error(F.lit("different texts share a SHA-256 digest")).cast("long"))
    return texts.groupBy("digest").agg(F.max("last").alias("keep_id"), one.alias("group_size"))


def exact_groups(docs: DataFrame, in_snapshot=None) -> DataFrame:
    """Every row's group: doc_id, digest, keep_id, group_size.

    ``in_snapshot`` is a condition on ``doc_id`` that tells the immutable
    snapshot's rows; the rest is the new batch (default: an even split by
    hash of the id).
    """
    docs = id_and_text(docs)
    rows = materialise(digests(docs), "digests")
    cond = F.coalesce(crc_bucket(F.col("doc_id"), 2) == 0, F.lit(True)) if in_snapshot is None else in_snapshot
    groups = digest_groups(rows.filter(cond), rows.filter(~cond))
    repeated = groups.filter("n > 1").select("digest")
    checked = materialise(byte_groups(docs, repeated), "byte-groups")
    return (rows.join(checked, "digest", "left")
            .select("doc_id", "digest",
                    F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size")))


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each set of equal texts, all columns kept.

    Rows that repeat the staying id and its text are reduced to one of them.
    """
    groups = materialise(exact_groups(docs), "exact-groups")
    stay = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    gone = groups.filter(~stay).select(F.col("doc_id").alias("gone")).distinct()
    kept = groups.filter(stay).groupBy("doc_id", "digest").agg(F.count(F.lit(1)).alias("n"))
    if kept.filter("n > 1").isEmpty() and kept.join(gone, kept["doc_id"].eqNullSafe(gone["gone"]), "left_semi").isEmpty():
        return docs.join(gone, docs["doc_id"].eqNullSafe(gone["gone"]), "left_anti")
    # Ids repeat: decide row by row, on id and digest, and leave one row of each.
    own, one = fresh_name(docs, "digest"), fresh_name(docs, "one")
    keep = kept.select(F.col("doc_id").alias("id"), F.col("digest").alias("d"))
    rows = docs.withColumn(own, F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)))
    rows = rows.join(keep, rows["doc_id"].eqNullSafe(keep["id"]) & (rows[own] == keep["d"]), "left_semi")
    rows = rows.withColumn(one, F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    return rows.dropDuplicates([one, own]).select(*docs.columns)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: every row of ``documents`` with its group of equal texts."""
    return exact_groups(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


OP6_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT d.doc_id, g.keep_id, g.group_size, (d.doc_id = g.keep_id) AS kept, sha256(d.t) AS text_sha256
FROM d JOIN g ON d.t = g.t
"""
