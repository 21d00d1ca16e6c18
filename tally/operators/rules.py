"""Keyword categorisation: an ordered rule table, first match wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.operators.observe import observe_rows


# The default rule table, in priority order (category, keywords).
# Matching is a case-insensitive substring test on the description.
DEFAULT_RULE_GROUPS: list[tuple[str, list[str]]] = [
    ("Groceries", ["WALMART", "KROGER", "WHOLEFDS", "WHOLE FOODS", "PUBLIX",
                   "TRADER JOE", "ALDI", "COSTCO", "SAM'S CLUB", "TARGET"]),
    ("Dining", ["MCDONALD", "CHIPOTLE", "STARBUCKS", "CHICK-FIL-A", "CHICK FIL A",
                "OLIVE GARDEN", "CHEESECAKE", "SUBWAY", "DOMINO", "PIZZA", "DOORDASH",
                "GRUBHUB", "UBER EATS", "PANERA", "TACO BELL"]),
    ("Transport", ["SHELL", "CHEVRON", "BP OIL", "RACETRAC", "EXXON", "SUNOCO", "UBER",
                   "LYFT", "PARKING", "SUNPASS", "TOLL"]),
    ("Subscriptions", ["NETFLIX", "SPOTIFY", "HULU", "DISNEY", "APPLE.COM/BILL",
                       "AMAZON PRIME", "YOUTUBE", "ADOBE", "MICROSOFT", "DROPBOX"]),
    ("Utilities", ["ELECTRIC", "FPL", "DUKE ENERGY", "COMCAST", "AT&T", "VERIZON",
                   "T-MOBILE", "WATER", "INTERNET", "XFINITY"]),
    ("Insurance", ["PROGRESSIVE", "GEICO", "STATE FARM", "ALLSTATE", "INSURANCE"]),
    ("Health", ["CVS", "WALGREENS", "PHARMACY", "DOCTOR", "MEDICAL", "DENTAL", "OPTUM"]),
    ("Fitness", ["PLANET FITNESS", "GOLD'S GYM", "LA FITNESS", "GYM", "PELOTON"]),
    ("Shopping", ["AMAZON", "BEST BUY", "HOME DEPOT", "LOWES", "IKEA", "WAYFAIR", "EBAY"]),
    ("Travel", ["DELTA", "UNITED AIR", "AMERICAN AIR", "SOUTHWEST", "MARRIOTT", "HILTON",
                "AIRBNB", "HOTEL"]),
    ("Income", ["PAYROLL", "DIRECT DEPOSIT", "INTEREST PAYMENT"]),
    ("Fees", ["FEE", "FOREIGN TRANSACTION", "LATE PAYMENT", "OVERDRAFT"]),
]
FALLBACK_CATEGORY = "Other"
# Provider categories that do not count as a category.
NON_CATEGORIES = ("", "Unknown")

# Up to this many rules one CASE per row compiles to generated code; longer
# rule lists are matched by a join on keyword fragments, with equal results.
CASE_RULES = 200
#: Letters of the fragment on which rules and descriptions are joined.
FRAGMENT = 4

Rule = tuple[int, str, str]  # (priority, keyword, category)


def default_rules() -> list[Rule]:
    rules: list[Rule] = []
    for category, keywords in DEFAULT_RULE_GROUPS:
        for kw in keywords:
            rules.append((len(rules) + 1, kw, category))
    return rules


def rules_frame(spark: SparkSession, rules: Sequence[Rule] | None = None) -> DataFrame:
    """The rule table as data: ``priority int, keyword string, category string``."""
    return spark.createDataFrame(default_rules() if rules is None else list(rules),
                                 "priority int, keyword string, category string")


def valid_provider(provider: Column) -> Column:
    return provider.isNotNull() & ~provider.isin(list(NON_CATEGORIES))


def ordered_rules(rules: Sequence[Rule]) -> list[Rule]:
    """Rules in the order in which they are tried: by priority, ties by keyword, then category.

    A rule without a priority, a keyword (an empty one included) or a category
    is no rule. ``match_rules`` does the same with a rule table.
    """
    whole = [(p, kw.upper(), cat) for p, kw, cat in rules if p is not None and kw and cat is not None]
    return sorted(whole, key=lambda r: (r[0], r[1].encode(), r[2].encode()))


def _sql_string(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _ident(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def category_sql(description: str = "description", provider: str | None = "provider_category",
                 rules: Sequence[Rule] | None = None) -> str:
    """The first-match CASE as SQL text over the named columns.

    Consecutive rules with the same category are merged into one branch, which
    keeps first-match semantics and makes a short CASE. A branch looks through
    an array of its keywords (``exists`` stops at the first that is found), so
    that the generated code does not grow with the rules: written out as 95
    ``contains`` tests it is a method too large for the JVM to compile.
    ``description`` must hold upper-case text.
    """
    ordered = ordered_rules(default_rules() if rules is None else rules)
    branches: list[tuple[str, list[str]]] = []
    for _, kw, cat in ordered:
        if branches and branches[-1][0] == cat:
            branches[-1][1].append(kw)
        else:
            branches.append((cat, [kw]))
    d = _ident(description)
    parts = []
    if provider is not None:
        p = _ident(provider)
        excluded = ", ".join(_sql_string(v) for v in NON_CATEGORIES)
        parts.append(f"WHEN {p} IS NOT NULL AND {p} NOT IN ({excluded}) THEN CAST({p} AS STRING)")
    for cat, kws in branches:
        keywords = ", ".join(_sql_string(kw) for kw in kws)
        parts.append(f"WHEN exists(array({keywords}), kw -> contains({d}, kw)) THEN {_sql_string(cat)}")
    if not parts:
        return _sql_string(FALLBACK_CATEGORY)
    return "CASE " + " ".join(parts) + f" ELSE {_sql_string(FALLBACK_CATEGORY)} END"


def category_expr(description: str = "description", provider: str | None = "provider_category",
                  rules: Sequence[Rule] | None = None) -> Column:
    """First-match CASE over the rules, one row at a time, no shuffle.

    Built as one SQL expression (a single call into the JVM, however many
    rules there are).
    """
    return F.expr(category_sql(description, provider, rules))


def categorize(ledger: DataFrame, rules: Sequence[Rule] | None = None,
               use_provider: bool = True) -> DataFrame:
    """Attach ``category`` and ``is_uncategorised`` to every ledger row.

    The reference attaches the category by a self-join on the unique id; on
    unique ids that equals computing it on the same row, which is what this
    does (no join, no shuffle). More than ``CASE_RULES`` rules go through
    ``categorize_with_rule_table``.
    """
    if rules is not None and len(rules) > CASE_RULES:
        return categorize_with_rule_table(ledger, rules_frame(ledger.sparkSession, rules), use_provider)
    cat = category_expr("description", "provider_category" if use_provider else None, rules)
    return (ledger.withColumn("category", cat)
                  .withColumn("is_uncategorised",
                              F.coalesce(F.col("category") == F.lit(FALLBACK_CATEGORY), F.lit(False))))


def hold_category_predicates(df: DataFrame, name: str = "categorized") -> DataFrame:
    """Observation point before a row filter on ``category``.

    Records the row and uncategorised counts. Without it Catalyst pushes a
    category filter below the projection that computes the category, copying
    the whole rule CASE (and the description expression into every rule)
    into the scan filter; with it the filter reads the computed column.
    """
    return observe_rows(df, name,
                        F.count(F.when(F.col("is_uncategorised"), F.lit(1))).alias("uncategorised"))


def read_rules(spark: SparkSession, path: str) -> DataFrame:
    """A seed CSV of rules as ``priority, keyword, category``.

    A seed with the columns ``keyword, category`` alone takes its priorities
    from the order of its files' names, of the blocks in a file and of the lines
    in a block, however Spark deals the blocks out: a priority is anything that
    sorts.
    """
    seed = spark.read.option("header", True).option("escape", '"').csv(path)
    if "priority" in seed.columns:
        place = F.col("priority").try_cast("long")
    else:
        place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                         F.monotonically_increasing_id().alias("line"))
    return seed.select(place.alias("priority"), "keyword", "category")


def _fragments(text: Column, size: int) -> Column:
    """Distinct substrings of ``size`` letters."""
    last = F.length(text) - F.lit(size - 1)
    return F.when(last >= 1, F.array_distinct(F.transform(
        F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substring(text, i, F.lit(size)))))


def match_rules(descriptions: DataFrame, rules_df: DataFrame) -> DataFrame:
    """``description, rule_category`` of the first rule (by priority) that each
    distinct description contains; descriptions without a match are left out.

    Every keyword of ``FRAGMENT`` letters or more hangs on its first
    fragment, a shorter one on all of itself; a description meets the rules
    of the fragments it holds (an equi-join whose strategy is chosen by bytes)
    and the whole keyword is then looked for. There is no limit to the number
    of rules, and none of them reaches the driver. Which rules count, and how
    ties are broken, is as in ``ordered_rules``.
    """
    rules = (rules_df.filter(F.col("priority").isNotNull() & (F.col("keyword") != "") & F.col("category").isNotNull())
             .select(F.col("priority").alias("_prio"), F.upper("keyword").alias("_kw"),
                     F.col("category").alias("_cat"))
             .withColumn("_part", F.substring("_kw", 1, FRAGMENT)))
    texts = descriptions.select("description").filter(F.col("description").isNotNull()).distinct()
    parts = F.concat(*[F.coalesce(_fragments(F.col("description"), k), F.array().cast("array<string>"))
                       for k in range(1, FRAGMENT + 1)])
    return (texts.select("description", F.explode(parts).alias("_part")).join(rules, "_part")
            .filter(F.col("description").contains(F.col("_kw")))
            .groupBy("description").agg(F.min_by("_cat", F.struct("_prio", "_kw", "_cat")).alias("rule_category")))


def categorize_with_rule_table(ledger: DataFrame, rules_df: DataFrame,
                               use_provider: bool = True) -> DataFrame:
    """Categorise from a rule table given as data (for example a CSV seed).

    Rules are matched once per distinct description and joined back.
    """
    hits = match_rules(ledger, rules_df).withColumnRenamed("description", "_text")
    joined = ledger.join(hits, F.col("description") == F.col("_text"), "left").drop("_text")
    cat = F.coalesce(F.col("rule_category"), F.lit(FALLBACK_CATEGORY))
    if use_provider:
        cat = F.when(valid_provider(F.col("provider_category")), F.col("provider_category")).otherwise(cat)
    return (joined.withColumn("category", cat).drop("rule_category")
                  .withColumn("is_uncategorised",
                              F.coalesce(F.col("category") == F.lit(FALLBACK_CATEGORY), F.lit(False))))
