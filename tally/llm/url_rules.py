"""Operator 2: URL filter by base rules and mined association rules.

Base rules (host, path) decide the urls they fit, the longest first. Those
decisions are the labels: Spark's FP-growth mines combinations of url tokens
together with a label, and combinations whose confidence and support suffice
become rules. A rule is dropped when a part of it already says the same with
no less confidence. So two kinds of tokens need not be combined, and long urls of
one template do not multiply: tokens that always occur together are one item
(any of them stands for it), and a token seen with one label alone is a rule by
itself that no larger one improves. Urls without a base rule are decided by the mined rule with
the highest confidence, then support, then size; without one they are allowed.

Matching is by inverted index: each rule hangs on its rarest token, so a url
meets only rules whose rarest token it has. Urls are matched once per distinct
set of tokens, which is grouped before the shuffle; joins are plain equi-joins
whose strategy Spark picks by size.

Defined cases: null urls and urls without ``://`` have an empty host and path,
no tokens, no rule and are allowed. Urls of any length are read whole. Repeated
rows give repeated results. An empty table, or one without a labelled url,
mines no rules. Columns other than id and url are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.llm.common import materialise, table

# The base rules.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))

MIN_SUPPORT, MIN_CONFIDENCE = 0.005, 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LABEL = "label="
#: Equal rows that one row stands for until they are counted.
PART = 100_000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url column; empty where there is none."""
    part = lambda k: F.coalesce(F.regexp_extract(url, r"://([^/?#]*)([^?#]*)", k), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def base_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):  # the longest ends outermost
        name, slash, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + rest))
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, decision).otherwise(verdict)
    return rule, verdict


def url_tokens(url: Column, host: Column, path: Column) -> Column:
    """Sorted distinct tokens: host labels and their parts, path words, names of parameters; numbers as one token."""
    lower = lambda c: F.translate(F.coalesce(c, F.lit("")), UPPER, LOWER)
    labels, parts = F.split(host, r"\."), F.split(host, r"[.-]")
    words = F.transform(F.split(lower(path), r"[/._~-]"),
                        lambda w: F.concat(F.lit("path:"), F.regexp_replace(w, r"^[0-9]+$", "0")))
    query = F.transform(F.split(F.regexp_extract(lower(url), r"\?([^#]*)", 1), "&"),
                        lambda w: F.concat(F.lit("query:"), F.regexp_extract(w, r"^[^=]*", 0)))
    hosts = F.transform(F.array_union(labels, parts), lambda w: F.concat(F.lit("host:"), w))
    every = F.array_distinct(F.concat(hosts, words, query))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        F.array_sort(F.filter(every, lambda w: ~F.endswith(w, F.lit(":")))))


def alike(labelled: DataFrame, least: int) -> DataFrame:
    """token, item, n, lo, hi of each token in at least ``least`` (tokens, verdict) rows.

    Tokens that occur in the same rows (by 128 bits of the rows' hashes) share an item, the smallest of them; n rows
    hold it, lo and hi are the first and last of their verdicts.
    """
    sets = labelled.groupBy("tokens", "verdict").agg(F.count(F.lit(1)).alias("n"))
    seen = sets.select("verdict", "n", F.xxhash64("tokens", "verdict", F.lit(1)).alias("h"),
                       F.xxhash64("tokens", "verdict", F.lit(2)).alias("g"), F.explode("tokens").alias("token"))
    found = seen.groupBy("token").agg(F.sum("n").alias("n"), F.bit_xor("h").alias("h"), F.bit_xor("g").alias("g"),
                                      F.min("verdict").alias("lo"), F.max("verdict").alias("hi")).filter(F.col("n") >= least)
    return found.withColumn("item", F.expr("min(token) over (partition by n, h, g)")).select("token", "item", "n", "lo", "hi")


def as_items(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """key, names (item -> the largest of its tokens here) of (key, tokens) rows; none for sets without an item."""
    return (sets.select("key", F.explode("tokens").alias("token")).join(classes.select("token", "item"), "token")
            .groupBy("key", "item").agg(F.max("token").alias("name")).groupBy("key")
            .agg(F.map_from_entries(F.collect_list(F.struct("item", "name"))).alias("names")))


def repeated(items: DataFrame, total: int) -> DataFrame:
    """Each row of (items, n) n times, in parts of at most ``PART`` rows that are spread over the tasks."""
    parts = (items.withColumn("part", F.explode(F.sequence(F.lit(1).cast("long"), F.ceil(F.col("n") / F.lit(PART)))))
             .withColumn("n", F.least(F.lit(PART).cast("long"), F.col("n") - (F.col("part") - 1) * PART))
             .repartition(1 + total // (4 * PART), "items", "part"))
    return parts.select("items", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("one")).select("items")


def mine_classes(labelled: DataFrame, min_support: float = MIN_SUPPORT,
                 min_confidence: float = MIN_CONFIDENCE) -> tuple[DataFrame, DataFrame]:
    """(rules kept: antecedent (items), verdict, confidence, support, anchor; classes) from (tokens, verdict) rows."""
    total = labelled.count()
    classes = materialise(alike(labelled, math.ceil(min_support * total)), "url-alike")
    singles = classes.filter("token = item")
    pure = singles.filter("lo = hi").select(F.array("item").alias("antecedent"), F.col("lo").alias("verdict"),
                                            F.lit(1.0).alias("confidence"), (F.col("n") / F.lit(max(1, total))).alias("support"))
    keyed = materialise(labelled.groupBy(F.array_join("tokens", " ").alias("key"), "verdict")
                        .agg(F.first("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")), "url-labelled")
    sets = keyed.groupBy("key").agg(F.first("tokens").alias("tokens"))
    held = as_items(sets, classes.filter("lo <> hi")).select("key", F.array_sort(F.map_keys("names")).alias("held"))
    none = F.array().cast("array<string>")
    items = materialise(keyed.join(held, "key", "left").groupBy(
        F.array_append(F.coalesce("held", none), F.concat(F.lit(LABEL), "verdict")).alias("items"))
        .agg(F.sum("n").alias("n")), "url-items")
    model = FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(repeated(items, total))
    rules = model.associationRules.filter(F.startswith(F.element_at("consequent", 1), F.lit(LABEL))).select(
        F.array_sort("antecedent").alias("antecedent"),
        F.expr(f"substring(consequent[0], {len(LABEL) + 1})").alias("verdict"), "confidence", "support")
    rules = rules.filter(~F.exists("antecedent", lambda w: F.startswith(w, F.lit(LABEL)))).unionByName(pure)
    rules = materialise(rules, "url-rules")
    anchors = (rules.select("antecedent", F.explode("antecedent").alias("item")).join(singles.select("item", "n"), "item")
               .groupBy("antecedent").agg(F.min_by("item", F.struct("n", "item")).alias("anchor")))
    rules = materialise(rules.join(anchors, "antecedent"), "url-anchored")
    parts = rules.select(F.col("antecedent").alias("part"), F.col("verdict").alias("same"),
                         F.col("confidence").alias("at_least"), F.col("anchor").alias("item"))
    idle = (rules.select("antecedent", "verdict", "confidence", F.explode("antecedent").alias("item"))
            .join(parts, "item")
            .filter((F.col("verdict") == F.col("same")) & (F.col("at_least") >= F.col("confidence"))
                    & (F.size("part") < F.size("antecedent")) & (F.size(F.array_except("part", "antecedent")) == 0))
            .select("antecedent", "verdict").distinct())
    return materialise(rules.join(idle, ["antecedent", "verdict"], "left_anti"), "url-kept"), classes


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """The rules alone."""
    return mine_classes(labelled, min_support, min_confidence)[0]


def match(sets: DataFrame, rules: DataFrame, classes: DataFrame | None = None) -> DataFrame:
    """key, mined (the best rule's tokens), mined_verdict for distinct token sets (key, tokens).

    Without ``classes`` (token, item) every token is an item of its own.
    """
    used = rules.select(F.explode("antecedent").alias("item")).distinct()
    classes = used.select(F.col("item").alias("token"), "item") if classes is None else classes.join(used, "item", "left_semi")
    hit = (as_items(sets, classes).select("key", "names", F.explode(F.map_keys("names")).alias("anchor")).join(rules, "anchor")
           .filter(F.size(F.array_except("antecedent", F.map_keys("names"))) == 0)
           .withColumn("mined", F.array_join(F.array_sort(F.transform("antecedent", lambda w: F.col("names")[w])), " ")))
    best = F.max_by(F.struct("mined", "verdict"),
                    F.struct("confidence", "support", F.size("antecedent"), "mined", "verdict"))
    return hit.groupBy("key").agg(best.alias("best")).select(
        "key", F.col("best.mined").alias("mined"), F.col("best.verdict").alias("mined_verdict"))


def filter_urls(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, min_support: float = MIN_SUPPORT,
                min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """page_id, host, path, rule, verdict, mined (the mined rule that decided; else null) of every row."""
    url = F.col("url")
    host, path = host_and_path(url)
    rows = pages.select("page_id", "url").withColumns({"host": host, "path": path})
    rule, verdict = base_rule(F.col("host"), F.col("path"), rules)
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("base"),
                       url_tokens(url, F.col("host"), F.col("path")).alias("tokens"))
    rows = materialise(rows.withColumn("key", F.array_join("tokens", " ")), "url-rows")
    labelled = rows.filter("base is not null").select("tokens", F.col("base").alias("verdict"))
    open_sets = rows.filter("base is null").groupBy("key").agg(F.first("tokens").alias("tokens"))
    mined, classes = mine_classes(labelled, min_support, min_confidence)
    found = materialise(match(open_sets, mined, classes), "url-matched")
    decided = F.col("rule").isNull()
    return rows.join(found, "key", "left").select(
        "page_id", "host", "path", "rule",
        F.coalesce("base", "mined_verdict", F.lit("allow")).alias("verdict"),
        F.when(decided, F.col("mined")).alias("mined"))


def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: the verdict on every page's url."""
    return filter_urls(table(spark, sf_dir, "pages"))
