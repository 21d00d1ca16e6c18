"""Operator 11: which filters remove what, in every order they can be applied.

Five failure conditions of a document (A short, B repetitive, C shouting, D
odd signs, E a copy of an earlier document) are five bits. A to D come from
the text alone. E is an existential self-join: the rows of repeated text
hashes meet, by hash, the exact texts under that hash, each with its smallest
doc_id, and a left-semi join on hash, text and a smaller doc_id marks the
copies; their ids are united with the other failures' and summed up into one
bit mask per document. Everything after that needs only how many documents
each part has of each of the 32 masks.

Scale: the texts cross the network once, to find those whose hash repeats;
only these are written, and meet again by hash and text, the smallest ids
found per task first. A hash's rows are dealt over ``SPREAD`` keys, then over
as many as its group needs at ``GROUP_ROWS`` rows each, so that one large
group of copies is not one task (the small side is repeated for each). The
counts are added up per task before their shuffle, by part and mask, so that
a source with a third of all rows is a few rows of each task. A part's 120
orders are laid out from its own row of at most 32 counts, without a join.

Defined cases: null text is the empty text; a null source is the part ''. A
row without an id is never a copy and makes none, as its id is not smaller
than any; rows that repeat an id are documents of their own, and share the
label that any label row of that id gives (a label row without id is
ignored, a null label is no label). Empty tables give no rows. Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.common import materialise, table

FILTERS = "ABCDE"
BLANKS = r"[\x20\x09-\x0D]+"
#: Join keys over which the rows of any text hash are dealt while it is not
#: known how many they are, and the rows of a hash that share a key after that.
SPREAD = 32
GROUP_ROWS = 1_000

MIN_WORDS = 50
MIN_DISTINCT = 65   # percent of the words
MAX_CAPITALS = 5    # percent of the code points
ODD_SIGNS = r"[#$%&*|]"


def _bit(letter: str) -> int:
    return 1 << FILTERS.index(letter)


def text_failures(text: Column) -> Column:
    """Bits A to D of a text that is not null."""
    words = F.array_remove(F.split(text, BLANKS), "")
    n, distinct = F.size(words), F.size(F.array_distinct(words))
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    failed = {"A": n < MIN_WORDS, "B": 100 * distinct < MIN_DISTINCT * n,
              "C": 100 * capitals > MAX_CAPITALS * F.length(text), "D": text.rlike(ODD_SIGNS)}
    return sum((F.when(cond, _bit(k)).otherwise(0) for k, cond in failed.items()), F.lit(0))


def copies(docs: DataFrame) -> DataFrame:
    """The rows of (doc_id, part, text, hash) whose exact text a smaller doc_id has too."""
    known = docs.filter("doc_id is not null")
    repeated = known.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    place = F.xxhash64("doc_id")
    dealt = known.withColumn("salt", F.pmod(place, F.lit(SPREAD)).cast("int")).join(
        repeated.select("hash", "n", F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("salt")), ["hash", "salt"])
    # Only the rows of repeated hashes are written, with the share of their group that a task takes.
    dealt = dealt.withColumn("salts", F.ceil(F.col("n") / GROUP_ROWS).cast("int")).drop("salt", "n")
    dealt = materialise(dealt.withColumn("salt", F.pmod(place, "salts").cast("int")), "repeated-texts")
    first = dealt.groupBy("hash", "text").agg(F.min("doc_id").alias("first"), F.max("salts").alias("salts")).select(
        F.col("hash").alias("r_hash"), F.col("text").alias("r_text"), "first",
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("r_salt"))
    return dealt.join(first, (F.col("hash") == F.col("r_hash")) & (F.col("salt") == F.col("r_salt"))
                      & (F.col("text") == F.col("r_text")) & (F.col("first") < F.col("doc_id")), "left_semi")


def failures(documents: DataFrame) -> DataFrame:
    """doc_id, part, mask, n: the documents of an id, their part and their failed conditions."""
    docs = documents.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                            F.coalesce("text", F.lit("")).alias("text")).withColumn("hash", F.xxhash64("text"))
    rows = materialise(docs.select("doc_id", "part", "hash", text_failures(F.col("text")).alias("mask")), "failures")
    copied = copies(docs).select("doc_id", "part", "hash", text_failures(F.col("text")).alias("mask"))
    # Rows of one id, part, hash and mask are copies of each other: a hash alone never tells documents apart.
    return (rows.withColumns({"n": F.lit(1), "copied": F.lit(0)})
            .unionByName(copied.withColumns({"n": F.lit(0), "copied": F.lit(_bit("E"))}))
            .groupBy("doc_id", "part", "hash", "mask").agg(F.sum("n").alias("n"), F.max("copied").alias("copied"))
            .select("doc_id", "part", F.col("mask").bitwiseOR(F.col("copied")).alias("mask"), "n"))


def mask_counts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, n, good, toxic: documents of each bit combination."""
    marks = (labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("l_id"))
             .agg(F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
                  F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")))
    rows = failures(documents).join(marks, F.col("doc_id") == F.col("l_id"), "left")
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("good"),
        F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("toxic"))


def _steps() -> Column:
    """Every step of every order: its filter's bit and the bits applied before it."""
    steps = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for k, letter in enumerate(order):
            steps.append((order, k + 1, _bit(letter), before))
            before |= _bit(letter)
    rows = ", ".join(f"struct('{o}' AS filter_order, {s} AS step, {b} AS bit, {p} AS before)" for o, s, b, p in steps)
    return F.expr(f"array({rows})")


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step."""
    counts = mask_counts(documents, labels)
    # At most 32 masks a part.
    per_part = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("masks"))
    s = per_part.select("part", "masks", F.explode(_steps()).alias("s")).select("part", "masks", "s.*")

    def total(value, cond) -> Column:
        return F.aggregate("masks", F.lit(0).cast("long"),
                           lambda acc, m: acc + F.when(cond(m["mask"]), value(m)).otherwise(F.lit(0)).cast("long"))

    bit, before = F.col("bit"), F.col("before")
    every = len(list(permutations(FILTERS)))
    fails = lambda m: m.bitwiseAND(bit) != 0
    removed = lambda m: fails(m) & (m.bitwiseAND(before) == 0)
    return s.select(
        "part", "filter_order", "step",
        total(lambda m: m["n"], lambda m: m.bitwiseAND(before.bitwiseOR(bit)) == 0).alias("kept"),
        total(lambda m: m["n"], removed).alias("removed"),
        total(lambda m: m["n"], lambda m: fails(m) & (m.bitwiseAND(before) != 0)).alias("redundant"),
        total(lambda m: m["n"], lambda m: m == bit).alias("unique_fails"),
        total(lambda m: m["good"], removed).alias("good_lost"),
        total(lambda m: m["toxic"], removed).alias("toxic_lost"),
        # Of a document's failing filters each comes first in an equal share of the orders.
        total(lambda m: m["n"] * every / F.bit_count(m["mask"]), fails).alias("shapley"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the audit of ``documents`` by source, in all 120 orders."""
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP11_SQL = r"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
firsts AS MATERIALIZED (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
marks AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
                 max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
f AS MATERIALIZED (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         len(w) < 50 AS fa, 100 * len(list_distinct(w)) < 65 * len(w) AS fb,
         100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS fc,
         regexp_matches(t, '[#$%&*|]') AS fd, coalesce(first < d.doc_id, false) AS fe
  FROM d JOIN firsts USING (t) LEFT JOIN marks ON marks.doc_id = d.doc_id),
grouped AS MATERIALIZED (
  SELECT part, concat(CASE WHEN fa THEN 'A' ELSE '' END, CASE WHEN fb THEN 'B' ELSE '' END,
                      CASE WHEN fc THEN 'C' ELSE '' END, CASE WHEN fd THEN 'D' ELSE '' END,
                      CASE WHEN fe THEN 'E' ELSE '' END) AS fails,
         count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY ALL),
orders(filter_order) AS (
  SELECT l FROM (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(l)
  UNION ALL
  SELECT filter_order || l FROM orders, (VALUES ('A'), ('B'), ('C'), ('D'), ('E')) v(l) WHERE NOT contains(filter_order, l)),
steps AS MATERIALIZED (
  SELECT filter_order, k::int AS step, substr(filter_order, k, 1) AS letter, substr(filter_order, 1, k - 1) AS earlier
  FROM orders, range(1, 6) r(k) WHERE length(filter_order) = 5),
seen AS MATERIALIZED (
  SELECT g.*, s.*, contains(fails, letter) AS hit,
         earlier <> '' AND regexp_matches(fails, '[' || earlier || 'x]') AS gone
  FROM grouped g, steps s),
rows AS MATERIALIZED (
  SELECT part, filter_order, step, letter,
         sum(CASE WHEN NOT hit AND NOT gone THEN n ELSE 0 END)::bigint AS kept,
         sum(CASE WHEN hit AND NOT gone THEN n ELSE 0 END)::bigint AS removed,
         sum(CASE WHEN hit AND gone THEN n ELSE 0 END)::bigint AS redundant,
         sum(CASE WHEN fails = letter THEN n ELSE 0 END)::bigint AS unique_fails,
         sum(CASE WHEN hit AND NOT gone THEN good ELSE 0 END)::bigint AS good_lost,
         sum(CASE WHEN hit AND NOT gone THEN toxic ELSE 0 END)::bigint AS toxic_lost
  FROM seen GROUP BY part, filter_order, step, letter)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, letter))::bigint AS shapley
FROM rows
"""
