"""Registered queries: one callable per operator key, (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables through ``sources.adapter`` and runs
over all of their rows. The keys match ``oracle_sql.oracle_queries``.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.functions.numeric import round_half_away, safe_div
from tally.functions.text import contains_any, null_tokens_to_null, strip_ws
from tally.operators import quality
from tally.operators.ledger import union_ledger
from tally.operators.rules import categorize_with_rule_table, category_expr, read_rules, rules_frame
from tally.schema import BANK, CARD, VALID_TRANSACTION_TYPES
from tally.session import scratch_path
from tally.sources.adapter import bank_export, card_export, card_export_dirty
from tally.sources.files import MALFORMED, file_readiness, map_to_common, read_source, write_csv
from tally.sources.loader import SourceFile, load_sources
from tally.sources.raw import RawStore, parse_number, standardise
from tally.sources.snapshots import SnapshotStore, file_system, names_in
from tally.streaming.incremental import stream_load

from tally.plans import marts
from tally.plans.models import (
    ModelOptions,
    int_all_transactions,
    int_categorized,
    raw_bank_from_tables,
    raw_card_from_tables,
    register_views,
)
from tally.operators.staging import stg_bank, stg_card

START = "1996-01-01"
MID_MONTH_START = "1996-01-15"
OPTS = ModelOptions(start_date=START)

LEDGER_COLS = [
    "unique_transaction_id", "transaction_id", "transaction_date", "description",
    "provider_category", "amount", "is_debit", "absolute_amount", "transaction_type", "source",
    "transaction_month", "transaction_year", "month_number", "year_number", "day_of_week",
    "quarter_number", "month_label", "is_payment", "is_transfer",
]

Query = Callable[[SparkSession, str], DataFrame]


def _raw(spark: SparkSession, sf: str, with_category: bool = False):
    return raw_bank_from_tables(spark, sf), raw_card_from_tables(spark, sf, with_category)


def categorized(spark: SparkSession, sf: str, opts: ModelOptions = OPTS) -> DataFrame:
    return int_categorized(*_raw(spark, sf), opts)


def ledger(spark: SparkSession, sf: str, opts: ModelOptions = OPTS) -> DataFrame:
    """The unified ledger without categories (income never reads them)."""
    return int_all_transactions(*_raw(spark, sf), opts)


def q_stg_bank(spark, sf):
    return stg_bank(raw_bank_from_tables(spark, sf)).drop("_loaded_at")


def q_stg_card(spark, sf):
    return stg_card(raw_card_from_tables(spark, sf)).drop("_loaded_at")


def q_int_all_transactions(spark, sf):
    return int_all_transactions(*_raw(spark, sf), OPTS).select(*LEDGER_COLS)


def q_int_categorized(spark, sf):
    return categorized(spark, sf).select(*LEDGER_COLS, "category", "is_uncategorised")


def q_mart_monthly_spend(spark, sf):
    return marts.mart_monthly_spend(categorized(spark, sf), START)


def q_mart_income(spark, sf):
    return marts.mart_income(ledger(spark, sf), START)


def q_mart_savings_rate(spark, sf):
    return marts.mart_savings_rate(categorized(spark, sf), START)


def q_mart_spending_stats(spark, sf):
    return marts.mart_spending_stats(categorized(spark, sf))


# --------------------------------------------------------------------------
# helpers for the operator keys
# --------------------------------------------------------------------------

DQ_AS_OF = "2000-01-01"  # fixed "now" for the future-date check, so results are stable


def as_read(df: DataFrame) -> DataFrame:
    """What a header CSV read returns: every column as text, null tokens NULL."""
    return df.select(*[null_tokens_to_null(F.col(c).cast("string")).alias(c) for c in df.columns])


def bank_text(spark, sf):
    return as_read(bank_export(spark, sf))


def card_text(spark, sf, with_category=False):
    return as_read(card_export(spark, sf, with_category))


def card_dirty_text(spark, sf):
    return as_read(card_export_dirty(spark, sf))


def _as_of():
    return F.lit(DQ_AS_OF).cast("timestamp_ntz")


def _spend_mart(spark, sf):
    return marts.mart_monthly_spend(categorized(spark, sf), START, ordered=False)


def _income_mart(spark, sf):
    return marts.mart_income(ledger(spark, sf), START, ordered=False)


def _savings(spark, sf, start=START):
    return marts.mart_savings_rate(categorized(spark, sf), start, ordered=False)


# --------------------------------------------------------------------------
# sources and sinks
# --------------------------------------------------------------------------

def _awkward(text):
    """A description with quotes, a comma and a trailing backslash, as exports may hold them."""
    return F.concat(F.lit('"Q", '), text, F.lit(' "x" \\'))


def q_read_bank(spark, sf):
    """A folder of exports in two column orders, each read by its own header."""
    export = bank_export(spark, sf).withColumn("description", _awkward(F.col("description")))
    folder, odd = scratch_path(spark, "bank-csv"), F.col("transaction_id").rlike("[13579]$")
    write_csv(export.filter(odd), folder + "/odd")
    write_csv(export.filter(~odd).select("amount", "description", "transaction_id", "transaction_type", "date"), folder + "/even")
    return read_source(spark, folder + "/*", BANK).drop(MALFORMED)


def q_read_card(spark, sf):
    export = card_export(spark, sf, with_category=True).withColumn("merchant_name", _awkward(F.col("merchant_name")))
    return read_source(spark, write_csv(export, scratch_path(spark, "card-csv")), CARD).drop(MALFORMED)


def q_dq_file_ready(spark, sf):
    """Readiness of two exports, an empty file and a path without one, with the rows that reading them finds."""
    paths = {"bank": write_csv(bank_export(spark, sf), scratch_path(spark, "bank-csv")),
             "card": write_csv(card_export(spark, sf), scratch_path(spark, "card-csv")),
             "empty": scratch_path(spark, "empty-csv"), "missing": scratch_path(spark, "no-csv")}
    spark.createDataFrame([], "value string").write.text(paths["empty"])
    rows = [read_source(spark, paths[s.name], s).agg(F.lit(s.name).alias("source"), F.count(F.lit(1)).alias("n_rows"))
            for s in (BANK, CARD)]
    counts = rows[0].unionByName(rows[1])
    return (file_readiness(spark, paths).join(counts, "source", "left")
            .select("source", "status", F.coalesce("n_rows", F.lit(0)).cast("long").alias("n_rows")))


def q_standardise(spark, sf):
    bank = standardise(map_to_common(bank_text(spark, sf), BANK))
    card = standardise(map_to_common(card_text(spark, sf), CARD))
    return bank.unionByName(card)


#: Buckets of the queries' raw tables: every month of a load has a file for each.
QUERY_BUCKETS = 2


def _store(spark) -> RawStore:
    return RawStore(spark, scratch_path(spark, "raw"), buckets=QUERY_BUCKETS)


def _stored(store):
    return store.read(BANK.raw_table).unionByName(store.read(CARD.raw_table))


def _first_batches(spark, sf):
    """Batches of a first load: rows whose key ends in 1..9 (the rest come later)."""
    bank = raw_bank_from_tables(spark, sf)
    card = raw_card_from_tables(spark, sf)
    early_bank = bank.filter(~F.col("transaction_id").endswith("0"))
    early_card = card.filter(~F.split(F.col("transaction_id"), "-").getItem(0).endswith("0"))
    return bank, card, early_bank, early_card


def q_load_full(spark, sf):
    store = _store(spark)
    bank, card, early_bank, early_card = _first_batches(spark, sf)
    store.load(early_bank, BANK.raw_table)
    store.load(early_card, CARD.raw_table)
    store.load(bank, BANK.raw_table, full_refresh=True)
    store.load(card, CARD.raw_table, full_refresh=True)
    return _stored(store)


def q_load_incremental(spark, sf):
    """First load about 90% of the ids, then the whole export with every
    description revised: only the new ids are added, stored rows stay."""
    store = _store(spark)
    bank, card, early_bank, early_card = _first_batches(spark, sf)
    store.load(early_bank, BANK.raw_table)
    store.load(early_card, CARD.raw_table)
    revised = F.concat(F.col("description"), F.lit(" (REVISED)"))
    store.load(bank.withColumn("description", revised), BANK.raw_table)
    store.load(card.withColumn("description", revised), CARD.raw_table)
    return _stored(store)


def q_load_outcome(spark, sf):
    files = [SourceFile("bank", write_csv(bank_export(spark, sf), scratch_path(spark, "bank-csv"))),
             SourceFile("card", write_csv(card_export(spark, sf), scratch_path(spark, "card-csv")))]
    outcome, _ = load_sources(spark, _store(spark), files)
    return outcome.select("source", "status", "rows_loaded")


def q_load_race(spark, sf):
    """Two loads follow the same version of the table, and their batches share
    a third of the ids: the one that ends later leaves out what the other stored."""
    store = _store(spark)
    bank, card, _, _ = _first_batches(spark, sf)
    for batch, table in ((bank, BANK.raw_table), (card, CARD.raw_table)):
        third = F.pmod(F.xxhash64("transaction_id"), F.lit(3))
        store.load(batch.filter(third == 0), table)
        rival = RawStore(spark, store.root, buckets=QUERY_BUCKETS)
        store.load(batch.filter(third != 0), table,
                   before_commit=lambda: rival.load(batch.filter(third < 2), table))  # noqa: B023
    return _stored(store)


def q_load_screened(spark, sf):
    """Loads into a table with Bloom filters: new ids, then the whole export with every description revised."""
    store = RawStore(spark, scratch_path(spark, "raw"), buckets=QUERY_BUCKETS, bloom_ids=100_000)
    bank, card, early_bank, early_card = _first_batches(spark, sf)
    for batch, early, table in ((bank, early_bank, BANK.raw_table), (card, early_card, CARD.raw_table)):
        even = F.pmod(F.xxhash64("transaction_id"), F.lit(2)) == 0
        store.load(early.filter(even), table)
        store.load(early.filter(~even), table)
        store.load(batch.withColumn("description", F.concat(F.col("description"), F.lit(" (REVISED)"))), table)
    return _stored(store)


def q_raw_since(spark, sf):
    """Raw rows of the months from a start date on, other months' files not read."""
    store = _store(spark)
    bank, card, early_bank, early_card = _first_batches(spark, sf)
    for batch in (early_bank, bank):
        store.load(batch, BANK.raw_table)
    for batch in (early_card, card):
        store.load(batch, CARD.raw_table)
    since = MID_MONTH_START
    return store.read(BANK.raw_table, since=since).unionByName(store.read(CARD.raw_table, since=since))


def q_mart_roundtrip(spark, sf):
    """The spend mart written over an older snapshot and read back; the older one stays readable until vacuumed."""
    store = SnapshotStore(spark, scratch_path(spark, "marts"))
    name = "mart_monthly_spend"
    older = marts.mart_monthly_spend(categorized(spark, sf), "1998-01-01", ordered=False)
    store.write(older, name)
    store.write(_spend_mart(spark, sf), name)
    store.vacuum(name, keep=1)
    return store.read(name)


#: Rows of a landed file; a larger export lands as several files, as a task writes each.
LANDED_ROWS = 1_000_000


def _land(spark, export, path: str) -> None:
    """One export as exactly this file (in place of what is there), a large one
    with further files beside it (``export-1-1.csv`` and so on)."""
    files = max(1, -(-export.count() // LANDED_ROWS))
    part = write_csv(export.coalesce(files), scratch_path(spark, "part-csv"))
    names = sorted(n for n in names_in(spark, part) if n.endswith(".csv"))
    fs, target = file_system(spark, path)
    fs.delete(target, False)
    fs.mkdirs(target.getParent())
    for k, name in enumerate(names):
        to = file_system(spark, path.removesuffix(".csv") + f"-{k}.csv")[1] if k else target
        fs.rename(file_system(spark, f"{part}/{name}")[1], to)


def q_load_stream(spark, sf):
    """Exports land in two runs: of the first run's files one repeats ids and one
    is empty, and both are quarantined; the second run's has its columns in
    another order, and the empty one has been filled in place. Returns the stored rows."""
    store = _store(spark)
    results = []
    for spec, export, text in ((BANK, bank_export(spark, sf), "description"), (CARD, card_export(spark, sf), "merchant_name")):
        landing = scratch_path(spark, f"landing-{spec.name}")
        checkpoint = scratch_path(spark, f"stream-ckpt-{spec.name}")
        late, filled = F.right("transaction_id", F.lit(1)).isin("0", "3", "6", "9"), F.endswith("transaction_id", F.lit("9"))
        _land(spark, export.filter(~late), landing + "/export-1.csv")
        bad = export.filter(late).limit(5)
        _land(spark, bad.unionByName(bad), landing + "/export-2.csv")
        fs, empty = file_system(spark, landing + "/export-4.csv")
        fs.create(empty).close()
        stream_load(spark, store, spec, landing, checkpoint)
        swapped = [c for c in export.columns if c not in (text, "transaction_type")] + ["transaction_type", text]
        _land(spark, export.filter(late & ~filled).select(*swapped), landing + "/export-3.csv")
        _land(spark, export.filter(filled), landing + "/export-4.csv")
        stream_load(spark, store, spec, landing, checkpoint)
        results.append(store.read(spec.raw_table))
    return results[0].unionByName(results[1])


def q_view_models(spark, sf):
    """The staging and intermediate models through their catalog views, by SQL alone."""
    register_views(*_raw(spark, sf), OPTS)
    return spark.sql("""
        SELECT 'int_categorized' AS model, source, category, count(*) AS n, count_if(is_payment) AS payments
        FROM int_categorized GROUP BY source, category
        UNION ALL
        SELECT 'int_all_transactions', source, CAST(NULL AS string), count(*), count_if(is_payment)
        FROM int_all_transactions GROUP BY source
        UNION ALL
        SELECT 'stg_bank_txns', source, CAST(NULL AS string), count(*), CAST(NULL AS bigint) FROM stg_bank_txns GROUP BY source
        UNION ALL
        SELECT 'stg_card_txns', source, CAST(NULL AS string), count(*), CAST(NULL AS bigint) FROM stg_card_txns GROUP BY source""")


def q_audit_time(spark, sf):
    """What holds of the load time of staged rows: present, one value a query, between the query's planning and now."""
    bank, card = _raw(spark, sf)
    start = F.lit(datetime.now(timezone.utc))
    staged = stg_bank(bank).select("source", "_loaded_at").unionByName(stg_card(card).select("source", "_loaded_at"))
    return staged.groupBy("source").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("_loaded_at").isNull()).alias("without_time"),
        (F.min("_loaded_at") == F.max("_loaded_at")).alias("one_time"),
        (F.min("_loaded_at") >= start).alias("not_before_the_query"),
        (F.max("_loaded_at") <= F.current_timestamp()).alias("not_after_the_query"))


# --------------------------------------------------------------------------
# projections, filters, classifications
# --------------------------------------------------------------------------

def q_union_ledger(spark, sf):
    return union_ledger(stg_bank(raw_bank_from_tables(spark, sf)),
                        stg_card(raw_card_from_tables(spark, sf))).drop("_loaded_at")


CAT_COLS = ["unique_transaction_id", "description", "provider_category", "category", "is_uncategorised"]


def q_categorize(spark, sf):
    return categorized(spark, sf).select(*CAT_COLS)


def q_categorize_rules(spark, sf):
    """Rules read from a ``keyword, category`` seed in file order, matched by
    the rule join (once per distinct description)."""
    seed = rules_frame(spark).coalesce(1).orderBy("priority").select("keyword", "category")
    rules = read_rules(spark, write_csv(seed.coalesce(1), scratch_path(spark, "rules-csv")))
    ledger = int_all_transactions(*_raw(spark, sf), OPTS)
    return categorize_with_rule_table(ledger, rules).select(*CAT_COLS)


def q_categorize_provider(spark, sf):
    opts = ModelOptions(start_date=START, carry_provider_category=True)
    return int_categorized(*_raw(spark, sf, with_category=True), opts).select(*CAT_COLS)


def q_spend_rows(spark, sf):
    return marts.spend_rows(categorized(spark, sf), START).select(
        "unique_transaction_id", "transaction_date", "category", "source", "absolute_amount")


def q_income_rows(spark, sf):
    return marts.income_rows(ledger(spark, sf), START).select(
        "unique_transaction_id", "transaction_date", "income_type", "source", "absolute_amount")


def q_income_type(spark, sf):
    c = ledger(spark, sf).filter(~F.col("is_debit"))
    return c.select("unique_transaction_id", "description",
                    marts.income_type_expr(F.col("description")).alias("income_type"))


def q_flag_payment(spark, sf):
    return int_all_transactions(*_raw(spark, sf), OPTS).select(
        "unique_transaction_id", "source", "transaction_type", "description", "is_payment")


def q_flag_transfer(spark, sf):
    return int_all_transactions(*_raw(spark, sf), OPTS).select(
        "unique_transaction_id", "description", "is_transfer")


def q_uncategorised_rate(spark, sf):
    c = categorized(spark, sf)
    return (c.groupBy("transaction_month")
            .agg(F.count(F.lit(1)).alias("transactions"),
                 F.count(F.when(F.col("is_uncategorised"), F.lit(1))).alias("uncategorised"))
            .withColumn("uncategorised_rate",
                        round_half_away(F.col("uncategorised") / F.col("transactions"), 4)))


def q_financial_health(spark, sf):
    return _savings(spark, sf).select("transaction_month", "total_income", "total_spend",
                                      "is_surplus_month", "financial_health_status")


def q_mart_savings_midmonth(spark, sf):
    return marts.mart_savings_rate(categorized(spark, sf), MID_MONTH_START)


# --------------------------------------------------------------------------
# joins
# --------------------------------------------------------------------------

def q_join_self_left(spark, sf):
    """The literal form: categories computed per id, then joined back."""
    ledger = int_all_transactions(*_raw(spark, sf), OPTS)
    keyword = ledger.select("unique_transaction_id",
                            category_expr("description", "provider_category").alias("category"))
    return (ledger.join(keyword, "unique_transaction_id", "left")
            .select("unique_transaction_id", "description", "category"))


def q_join_full_outer(spark, sf):
    return marts.join_months_full_outer(marts.rollup_income_month(_income_mart(spark, sf)),
                                        marts.rollup_spend_month(_spend_mart(spark, sf)))


# --------------------------------------------------------------------------
# aggregates and windows
# --------------------------------------------------------------------------

def q_agg_spend(spark, sf):
    return marts.agg_spend(categorized(spark, sf), START)


def q_agg_income(spark, sf):
    return marts.agg_income(ledger(spark, sf), START)


def q_rollup_income_month(spark, sf):
    return marts.rollup_income_month(_income_mart(spark, sf))


def q_rollup_spend_month(spark, sf):
    return marts.rollup_spend_month(_spend_mart(spark, sf))


def q_agg_month_category(spark, sf):
    return marts.agg_month_category(categorized(spark, sf)).drop("_sum_d", "_sum_b")


def q_agg_median(spark, sf):
    return marts.mart_spending_stats(categorized(spark, sf), ordered=False).select(
        "category", "median_monthly_spend")


def q_agg_stddev(spark, sf):
    m = marts.agg_month_category(categorized(spark, sf))
    return m.groupBy("category").agg(
        round_half_away(F.stddev_samp("total_spend")).alias("stddev_monthly_spend"),
        F.count(F.lit(1)).alias("n_months"))


SPEND_KEYS = ["transaction_month", "category", "source"]
INCOME_KEYS = ["transaction_month", "income_type", "source"]


def q_win_rank(spark, sf):
    return _spend_mart(spark, sf).select(*SPEND_KEYS, "total_spend", "category_spend_rank")


def q_win_lag_spend(spark, sf):
    return _spend_mart(spark, sf).select(*SPEND_KEYS, "total_spend", "mom_spend_change")


def q_win_share_spend(spark, sf):
    return _spend_mart(spark, sf).select(*SPEND_KEYS, "pct_of_monthly_spend")


def q_win_lag_income(spark, sf):
    return _income_mart(spark, sf).select(*INCOME_KEYS, "total_income", "mom_income_change")


def q_win_share_income(spark, sf):
    return _income_mart(spark, sf).select(*INCOME_KEYS, "total_monthly_income", "pct_of_monthly_income")


def q_win_cumulative(spark, sf):
    return _savings(spark, sf).select("transaction_month", "net_savings", "cumulative_savings")


def q_win_lag_global(spark, sf):
    return _savings(spark, sf).select("transaction_month", "mom_income_change", "mom_spend_change",
                                      "prior_month_savings_rate")


def q_top_n_categories(spark, sf, n: int = 3):
    return _spend_mart(spark, sf).filter(F.col("category_spend_rank") <= n).select(
        *SPEND_KEYS, "total_spend", "category_spend_rank")


# --------------------------------------------------------------------------
# scalar functions
# --------------------------------------------------------------------------

def q_scalar_calendar(spark, sf):
    return int_all_transactions(*_raw(spark, sf), OPTS).select(
        "unique_transaction_id", "transaction_date", "transaction_month", "transaction_year",
        "month_number", "year_number", "day_of_week", "quarter_number", "month_label")


def q_scalar_clean(spark, sf):
    t = card_text(spark, sf)
    desc = F.upper(strip_ws(F.col("merchant_name")))
    return t.select(
        "transaction_id", "merchant_name",
        desc.alias("description"),
        F.lower(strip_ws(F.col("transaction_type"))).alias("transaction_type"),
        F.concat(F.lit("card-"), F.col("transaction_id")).alias("unique_transaction_id"),
        contains_any(desc, ["PAYMENT"]).alias("mentions_payment"))


def q_scalar_amount(spark, sf):
    t = card_dirty_text(spark, sf)
    a = parse_number(F.col("amount"))
    return t.select(
        "transaction_id", F.col("amount").alias("amount_text"),
        a.alias("amount"), (a * F.lit(-1)).alias("flipped"), F.abs(a).alias("absolute_amount"),
        round_half_away(a / F.lit(3.0)).alias("third_rounded"),
        round_half_away(a / F.lit(7.0), 4).alias("seventh_rounded"))


def q_scalar_guarded_ratio(spark, sf):
    j = q_join_full_outer(spark, sf)
    return j.select("transaction_month", "total_income", "total_spend",
                    round_half_away(safe_div(F.col("total_spend"), F.col("total_income")) * F.lit(100.0))
                    .alias("spending_rate"),
                    F.coalesce(round_half_away(safe_div(F.col("total_spend"), F.col("total_income"))
                                               * F.lit(100.0)), F.lit(0.0)).alias("spending_rate_or_zero"),
                    (F.col("total_income") - F.col("total_spend")).alias("difference"))


# --------------------------------------------------------------------------
# data quality
# --------------------------------------------------------------------------

DQ_COLS = ["source", "check", "severity", "column", "n_bad"]


def _dq_inputs(spark, sf):
    return [(bank_text(spark, sf), BANK), (card_dirty_text(spark, sf), CARD)]


def _dq_rows(spark, sf, checks: set[str]):
    parts = [quality.row_checks(df, spec, _as_of()) for df, spec in _dq_inputs(spark, sf)]
    out = parts[0].unionByName(parts[1])
    return out.filter(F.col("check").isin(sorted(checks))).select(*DQ_COLS)


def q_dq_columns(spark, sf):
    """Written exports, one without its description and one with a further
    column, validated from their files."""
    bank = write_csv(bank_export(spark, sf).drop("description"), scratch_path(spark, "bank-csv"))
    card = write_csv(card_export(spark, sf, with_category=True), scratch_path(spark, "card-csv"))
    parts = [quality.validate_file(spark, path, name, _as_of(), with_samples=False)
             for path, name in ((bank, "bank"), (card, "card"), (card, "loan"), (card + "-none", "card"))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    wanted = ("required_columns", "extra_columns", "rows_read", "malformed_rows", "known_source", "file_ready")
    return out.filter(F.col("check").isin(*wanted)).select(*DQ_COLS)


def q_dq_row_count(spark, sf):
    return _dq_rows(spark, sf, {"rows_read", "row_count_min", "row_count_max"})


def q_dq_duplicates(spark, sf):
    parts = [quality.duplicate_ids(df, spec) for df, spec in _dq_inputs(spark, sf)]
    return parts[0].unionByName(parts[1]).select(*DQ_COLS)


def q_dq_nulls(spark, sf):
    return _dq_rows(spark, sf, {"nulls"})


def q_dq_dates(spark, sf):
    return _dq_rows(spark, sf, {"unparseable_dates", "future_dates"})


def q_dq_amounts(spark, sf):
    return _dq_rows(spark, sf, {"non_numeric_amounts", "amount_out_of_bounds", "zero_amounts"})


def q_dq_types(spark, sf):
    parts = []
    for df, spec in _dq_inputs(spark, sf):
        t = quality.normalised_type(spec)
        parts.append(df.groupBy(t.alias("transaction_type")).agg(F.count(F.lit(1)).alias("n"))
                     .select(F.lit(spec.name).alias("source"), "transaction_type", "n",
                             F.col("transaction_type").isin(list(VALID_TRANSACTION_TYPES)).alias("is_valid")))
    return parts[0].unionByName(parts[1])


def q_dq_samples(spark, sf):
    parts = [quality.samples(df, spec, _as_of()) for df, spec in _dq_inputs(spark, sf)]
    return parts[0].unionByName(parts[1]).select(
        "source", "check", "column", F.array_join("sample", ",").alias("sample"))


def q_dq_report(spark, sf):
    parts = [quality.profile(spark, df, spec, _as_of(), with_samples=False) for df, spec in _dq_inputs(spark, sf)]
    return quality.summarise(parts[0].unionByName(parts[1]))


def q_dq_load_gate(spark, sf):
    bank = standardise(map_to_common(bank_text(spark, sf), BANK))
    card = standardise(map_to_common(card_text(spark, sf), CARD))
    dirty = standardise(map_to_common(card_dirty_text(spark, sf), CARD))
    return (quality.load_gate(bank, "bank").unionByName(quality.load_gate(card, "card"))
            .unionByName(quality.load_gate(dirty, "card_dirty")))


def q_dq_rejects(spark, sf):
    bank = standardise(map_to_common(bank_text(spark, sf), BANK))
    dirty = standardise(map_to_common(card_dirty_text(spark, sf), CARD))
    return quality.rejects(bank, "bank").unionByName(quality.rejects(dirty, "card_dirty"))


def q_test_not_null(spark, sf):
    stats = marts.mart_spending_stats(categorized(spark, sf), ordered=False)
    return quality.test_not_null(stats, "mart_spending_stats", ["category", "mean_monthly_spend"])


def q_test_unique(spark, sf):
    stats = marts.mart_spending_stats(categorized(spark, sf), ordered=False)
    return quality.test_unique(stats, "mart_spending_stats", "category")


QUERIES: dict[str, Query] = {
    "stg_bank": q_stg_bank,
    "stg_card": q_stg_card,
    "int_all_transactions": q_int_all_transactions,
    "int_categorized": q_int_categorized,
    "mart_monthly_spend": q_mart_monthly_spend,
    "mart_income": q_mart_income,
    "mart_savings_rate": q_mart_savings_rate,
    "mart_spending_stats": q_mart_spending_stats,
    # sources and sinks
    "read_bank": q_read_bank,
    "read_card": q_read_card,
    "dq_file_ready": q_dq_file_ready,
    "standardise": q_standardise,
    "load_full": q_load_full,
    "load_incremental": q_load_incremental,
    "load_outcome": q_load_outcome,
    "mart_roundtrip": q_mart_roundtrip,
    "load_stream": q_load_stream,
    "load_race": q_load_race,
    "load_screened": q_load_screened,
    "raw_since": q_raw_since,
    "view_models": q_view_models,
    "audit_time": q_audit_time,
    # projections, filters, classification
    "union_ledger": q_union_ledger,
    "categorize": q_categorize,
    "categorize_rules": q_categorize_rules,
    "categorize_provider": q_categorize_provider,
    "spend_rows": q_spend_rows,
    "income_rows": q_income_rows,
    "income_type": q_income_type,
    "flag_payment": q_flag_payment,
    "flag_transfer": q_flag_transfer,
    "uncategorised_rate": q_uncategorised_rate,
    "financial_health": q_financial_health,
    "mart_savings_midmonth": q_mart_savings_midmonth,
    # joins
    "join_self_left": q_join_self_left,
    "join_full_outer": q_join_full_outer,
    # aggregates
    "agg_spend": q_agg_spend,
    "agg_income": q_agg_income,
    "rollup_income_month": q_rollup_income_month,
    "rollup_spend_month": q_rollup_spend_month,
    "agg_month_category": q_agg_month_category,
    "agg_median": q_agg_median,
    "agg_stddev": q_agg_stddev,
    # windows, sort/limit
    "win_rank": q_win_rank,
    "win_lag_spend": q_win_lag_spend,
    "win_share_spend": q_win_share_spend,
    "win_lag_income": q_win_lag_income,
    "win_share_income": q_win_share_income,
    "win_cumulative": q_win_cumulative,
    "win_lag_global": q_win_lag_global,
    "top_n_categories": q_top_n_categories,
    # scalar functions
    "scalar_calendar": q_scalar_calendar,
    "scalar_clean": q_scalar_clean,
    "scalar_amount": q_scalar_amount,
    "scalar_guarded_ratio": q_scalar_guarded_ratio,
    # data quality
    "dq_columns": q_dq_columns,
    "dq_row_count": q_dq_row_count,
    "dq_duplicates": q_dq_duplicates,
    "dq_nulls": q_dq_nulls,
    "dq_dates": q_dq_dates,
    "dq_amounts": q_dq_amounts,
    "dq_types": q_dq_types,
    "dq_samples": q_dq_samples,
    "dq_report": q_dq_report,
    "dq_load_gate": q_dq_load_gate,
    "dq_rejects": q_dq_rejects,
    "test_not_null": q_test_not_null,
    "test_unique": q_test_unique,
}
