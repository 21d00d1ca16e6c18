"""Reporting marts over the categorised ledger.

Money is summed as decimals of six places (exact, whatever the order of rows),
with amounts beyond that range summed as doubles beside them; results are
rounded where the marts round and turned back into DOUBLE. Every mart groups by (month, dimension, source) only and derives the other
calendar columns from the month afterwards, which keeps the shuffled rows
narrow; the windows then run over the small aggregated result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tally.functions.calendar import month_label
from tally.functions.numeric import Money, round_half_away, safe_div
from tally.functions.text import contains_any
from tally.operators.observe import observe_rows
from tally.operators.rules import hold_category_predicates
from tally.schema import DEFAULT_START_DATE

TIME_KEYS = ["transaction_month", "month_label", "year_number", "month_number", "quarter_number"]

# Income types, first match wins (keywords are substrings).
INCOME_TYPE_RULES: list[tuple[str, list[str]]] = [
    ("Payroll", ["PAYROLL", "DIRECT DEPOSIT"]),
    ("Interest", ["INTEREST"]),
    ("Refund", ["REFUND", "RETURN", "CREDIT"]),
    ("Peer transfer", ["VENMO", "ZELLE", "CASHAPP"]),
    ("Rewards", ["CASHBACK", "REWARDS"]),
]
OTHER_INCOME = "Other income"

# Savings-ratio bands (ratio = (income - spend) / income).
HEALTH_BANDS: list[tuple[float, str]] = [(0.20, "Healthy"), (0.05, "On track"), (0.0, "Tight")]
DEFICIT = "Deficit"
NO_INCOME = "No income data"
UNKNOWN_LABEL = "Unknown"


# --------------------------------------------------------------------------
# column helpers
# --------------------------------------------------------------------------

def time_keys(month: Column) -> list[Column]:
    return [
        month.alias("transaction_month"),
        month_label(month).alias("month_label"),
        F.year(month).cast("long").alias("year_number"),
        F.month(month).cast("long").alias("month_number"),
        F.quarter(month).cast("long").alias("quarter_number"),
    ]


def income_type_expr(description: Column) -> Column:
    expr = None
    for label, kws in INCOME_TYPE_RULES:
        cond = contains_any(description, kws)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(OTHER_INCOME))


def health_status(income: Column, ratio: Column) -> Column:
    expr = F.when(income == 0, F.lit(NO_INCOME))
    for bound, label in HEALTH_BANDS:
        expr = expr.when(ratio >= F.lit(bound), F.lit(label))
    return expr.otherwise(F.lit(DEFICIT))


def _start(start_date: str) -> Column:
    return F.lit(start_date).cast("date")


# --------------------------------------------------------------------------
# row selections
# --------------------------------------------------------------------------

def spend_predicate() -> Column:
    return (F.col("is_debit") & ~F.col("is_payment") & ~F.col("is_transfer")
            & (F.col("category") != F.lit("Income")))


def income_predicate() -> Column:
    return ~F.col("is_debit") & ~F.col("is_transfer") & ~F.col("is_payment")


def _spend_candidates(categorized: DataFrame, start_date: str) -> DataFrame:
    """Debits that are neither payments nor transfers, on or after the start.

    The category test of the spend predicate is left out on purpose: a row
    filter on ``category`` would be pushed below the projection that computes
    it and expand the whole rule CASE (and the description expression inside
    every rule) into the scan filter. Income-category groups are removed
    after aggregation instead, which gives the same groups.
    """
    return categorized.filter(F.col("is_debit") & ~F.col("is_payment") & ~F.col("is_transfer")
                              & (F.col("transaction_date") >= _start(start_date)))


def spend_rows(categorized: DataFrame, start_date: str = DEFAULT_START_DATE) -> DataFrame:
    """Debits that are spend: no payments, transfers or income, on or after start.

    The cheap conjuncts filter first (the date reaches the scan); the
    category test runs after an observation point, on the computed column.
    """
    candidates = _spend_candidates(categorized, start_date)
    return hold_category_predicates(candidates, "spend_candidates").filter(
        F.col("category") != F.lit("Income"))


def income_rows(categorized: DataFrame, start_date: str = DEFAULT_START_DATE) -> DataFrame:
    """Credits that are income (category is not consulted), with their type."""
    return (categorized.filter(income_predicate() & (F.col("transaction_date") >= _start(start_date)))
            .withColumn("income_type", income_type_expr(F.col("description"))))


# --------------------------------------------------------------------------
# grouped measures shared by the spend and income marts
# --------------------------------------------------------------------------

def _grouped(rows: DataFrame, dim: str) -> DataFrame:
    a = F.col("absolute_amount")
    return (rows.groupBy("transaction_month", dim, "source")
            .agg(*Money.of(a).sum().columns("_sum"),
                 F.count(F.lit(1)).alias("transaction_count"),
                 F.min(a).alias("_min"),
                 F.max(a).alias("_max")))


def _measures(total: str) -> list[Column]:
    """Rounded total, row count and rounded average of grouped rows."""
    value = Money.named("_sum").value()
    return [round_half_away(value).alias(total), F.col("transaction_count"),
            round_half_away(value / F.col("transaction_count")).alias("avg_transaction_amount")]


def agg_spend(categorized: DataFrame, start_date: str = DEFAULT_START_DATE) -> DataFrame:
    """Spend measures per month, category and source (before the windows)."""
    g = _grouped(spend_rows(categorized, start_date), "category")
    return g.select(*time_keys(F.col("transaction_month")), "category", "source", *_measures("total_spend"),
                    round_half_away(F.col("_min")).alias("min_transaction_amount"),
                    round_half_away(F.col("_max")).alias("max_transaction_amount"))


def agg_income(categorized: DataFrame, start_date: str = DEFAULT_START_DATE) -> DataFrame:
    """Income measures per month, income type and source (before the windows)."""
    g = _grouped(income_rows(categorized, start_date), "income_type")
    return g.select(*time_keys(F.col("transaction_month")), "income_type", "source", *_measures("total_income"),
                    round_half_away(F.col("_max")).alias("largest_transaction_amount"))


# --------------------------------------------------------------------------
# marts
# --------------------------------------------------------------------------

def mart_monthly_spend(categorized: DataFrame, start_date: str = DEFAULT_START_DATE,
                       ordered: bool = True) -> DataFrame:
    """Spend by month x category x source with rank, change and share.

    Aggregates every candidate debit (one partial + final aggregation), then
    runs the windows on the small grouped result. Income groups stay in the
    grouped rows until after the windows but never count: they sort after
    every spend group in the rank and add nothing to the month total, and the
    lag is partitioned by category so they have their own partition. The groups
    pass an observation point: a query that drops the rank leaves no window that
    stops their removal from being pushed to the scan, with the whole rule CASE.
    """
    groups = observe_rows(_grouped(_spend_candidates(categorized, start_date), "category"), "spend_groups")
    return _spend_windows(groups, ordered)


def _change(money: Money, previous: Money) -> Column:
    """Rounded difference to the previous row, zero without one."""
    return round_half_away(F.coalesce(money.minus(previous).value(), F.lit(0.0)))


def _spend_windows(g: DataFrame, ordered: bool) -> DataFrame:
    """Rank, change and share over grouped spend candidates
    (transaction_month, category, source, _sum, transaction_count, _min, _max)."""
    income_group = F.col("category") == F.lit("Income")
    spent = Money.named("_sum")
    by_group = Window.partitionBy("category", "source").orderBy("transaction_month")
    g = g.select("*", *spent.lag(by_group).columns("_lag"))
    by_month = Window.partitionBy("transaction_month")
    ranked = g.select(
        "*",
        F.rank().over(by_month.orderBy(income_group.asc(), spent.value().desc())).alias("_rank"),
        *spent.when(~income_group).sum().over(by_month).columns("_month"),
    ).filter(~income_group)
    out = ranked.select(
        *time_keys(F.col("transaction_month")),
        "category", "source",
        *_measures("total_spend"),
        round_half_away(F.col("_min")).alias("min_transaction_amount"),
        round_half_away(F.col("_max")).alias("max_transaction_amount"),
        F.col("_rank").cast("long").alias("category_spend_rank"),
        _change(spent, Money.named("_lag")).alias("mom_spend_change"),
        round_half_away(safe_div(spent.value(), Money.named("_month").value()) * F.lit(100.0))
        .alias("pct_of_monthly_spend"),
    )
    return out.orderBy(F.desc("transaction_month"), F.desc("total_spend")) if ordered else out


def mart_income(categorized: DataFrame, start_date: str = DEFAULT_START_DATE,
                ordered: bool = True) -> DataFrame:
    """Income by month x income type x source with change and share."""
    return _income_windows(_grouped(income_rows(categorized, start_date), "income_type"), ordered)


def _income_windows(g: DataFrame, ordered: bool) -> DataFrame:
    earned = Money.named("_sum")
    by_group = Window.partitionBy("income_type", "source").orderBy("transaction_month")
    by_month = Window.partitionBy("transaction_month")
    g = g.select("*", *earned.lag(by_group).columns("_lag"), *earned.sum().over(by_month).columns("_month"))
    month_total = Money.named("_month").value()
    out = g.select(
        *time_keys(F.col("transaction_month")),
        "income_type", "source",
        *_measures("total_income"),
        round_half_away(F.col("_max")).alias("largest_transaction_amount"),
        _change(earned, Money.named("_lag")).alias("mom_income_change"),
        round_half_away(month_total).alias("total_monthly_income"),
        round_half_away(safe_div(earned.value(), month_total) * F.lit(100.0)).alias("pct_of_monthly_income"),
    )
    return out.orderBy(F.desc("transaction_month"), F.desc("total_income")) if ordered else out


def _months_from_groups(groups: DataFrame) -> DataFrame:
    """Income and spend per month from grouped rows (transaction_month, dim,
    is_income, _sum, _n): the sums of the marts' rounded totals."""
    r = Money.of(round_half_away(Money.named("_sum").value()))
    income = F.col("is_income")
    spend = ~income & (F.col("dim") != F.lit("Income"))
    months = (groups.groupBy("transaction_month")
              .agg(*r.when(income).sum().columns("_i"), *r.when(spend).sum().columns("_s"),
                   F.sum(F.when(income, F.col("_n")).otherwise(0)).alias("income_n"),
                   F.sum(F.when(spend, F.col("_n")).otherwise(0)).alias("spend_n")))
    # A month whose rows are all debits in the Income category has neither
    # side, so neither mart has it and the join would not produce it either.
    # (Filtered here, after the sums: a filter on the groups would be pushed
    # to the scan and copy the rule CASE into it.)
    return months.filter((F.col("income_n") > 0) | (F.col("spend_n") > 0))


def monthly_activity(categorized: DataFrame, start_date: str = DEFAULT_START_DATE) -> DataFrame:
    """Income and spend per month in one pass over the ledger.

    Equal to rolling the income and spend marts up to months and joining
    them with a full outer join: rows are grouped as both marts group them
    (income type or category, and source), each group's total is rounded as the
    marts round it, and the rounded totals are added per month. Only the first
    grouping reads rows; the second adds a few groups a month.
    """
    is_income = ~F.col("is_debit")
    # Only the cheap conjuncts filter rows; the category is a grouping column,
    # so the rule CASE is computed once per row.
    rows = categorized.filter(~F.col("is_transfer") & ~F.col("is_payment")
                              & (F.col("transaction_date") >= _start(start_date)))
    dim = F.when(is_income, income_type_expr(F.col("description"))).otherwise(F.col("category"))
    groups = (rows.groupBy("transaction_month", dim.alias("dim"), "source", is_income.alias("is_income"))
              .agg(*Money.of(F.col("absolute_amount")).sum().columns("_sum"), F.count(F.lit(1)).alias("_n")))
    return _months_from_groups(groups)


def savings_from_months(months: DataFrame, start_date: str = DEFAULT_START_DATE) -> DataFrame:
    """Savings metrics from one row per month.

    Input columns: transaction_month, the money sums ``_i`` and ``_s`` (NULL
    when the side has no rows), income_n, spend_n. The month-level start
    filter is applied before the windows. The windows have no partition key:
    they see one row per calendar month, so their size is bounded by the date
    range, not by the data volume.
    """
    has_income = F.col("income_n") > 0
    m = months.filter(F.col("transaction_month") >= _start(start_date))
    m = m.select(
        "transaction_month",
        F.when(has_income, month_label(F.col("transaction_month")))
         .otherwise(F.lit(UNKNOWN_LABEL)).alias("month_label"),
        F.when(has_income, F.year("transaction_month")).otherwise(F.lit(0)).cast("long").alias("year_number"),
        F.when(has_income, F.month("transaction_month")).otherwise(F.lit(0)).cast("long").alias("month_number"),
        F.when(has_income, F.quarter("transaction_month")).otherwise(F.lit(0)).cast("long").alias("quarter_number"),
        *Money.named("_i").filled().columns("_i"), *Money.named("_s").filled().columns("_s"),
        F.coalesce(F.col("income_n"), F.lit(0)).cast("long").alias("income_transaction_count"),
        F.coalesce(F.col("spend_n"), F.lit(0)).cast("long").alias("spend_transaction_count"),
    )
    by_time = Window.orderBy("transaction_month")
    running = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earned, spent = Money.named("_i"), Money.named("_s")
    saved = earned.minus(spent)
    income, spend, net = earned.value(), spent.value(), saved.value()
    ratio = safe_div(net, income)
    rate = round_half_away(ratio * F.lit(100.0))
    return m.select(
        *TIME_KEYS,
        income.alias("total_income"),
        spend.alias("total_spend"),
        round_half_away(net).alias("net_savings"),
        rate.alias("savings_rate"),
        round_half_away(safe_div(spend, income) * F.lit(100.0)).alias("spending_rate"),
        F.lag(rate).over(by_time).alias("prior_month_savings_rate"),
        round_half_away(saved.sum().over(running).value()).alias("cumulative_savings"),
        round_half_away(earned.minus(earned.lag(by_time)).value()).alias("mom_income_change"),
        round_half_away(spent.minus(spent.lag(by_time)).value()).alias("mom_spend_change"),
        (net >= 0).alias("is_surplus_month"),
        health_status(income, ratio).alias("financial_health_status"),
        "income_transaction_count", "spend_transaction_count",
        (F.col("income_transaction_count") + F.col("spend_transaction_count")).alias("total_transaction_count"),
    )


def mart_savings_rate(categorized: DataFrame, start_date: str = DEFAULT_START_DATE,
                      ordered: bool = True) -> DataFrame:
    """Monthly savings rate, running savings, trends and health band."""
    out = savings_from_months(monthly_activity(categorized, start_date), start_date)
    return out.orderBy(F.desc("transaction_month")) if ordered else out


# --------------------------------------------------------------------------
# the literal form: month roll-ups of the two marts and a full outer join
# --------------------------------------------------------------------------

def rollup_income_month(income_mart: DataFrame) -> DataFrame:
    return (income_mart.groupBy(*TIME_KEYS)
            .agg(Money.of(F.col("total_income")).sum().value().alias("total_income"),
                 F.sum("transaction_count").cast("long").alias("income_transaction_count")))


def rollup_spend_month(spend_mart: DataFrame) -> DataFrame:
    return (spend_mart.groupBy("transaction_month")
            .agg(Money.of(F.col("total_spend")).sum().value().alias("total_spend"),
                 F.sum("transaction_count").cast("long").alias("spend_transaction_count")))


def join_months_full_outer(income_months: DataFrame, spend_months: DataFrame) -> DataFrame:
    """Full outer join on the month; the calendar columns come from the
    income side only, so a spend-only month is 'Unknown' / 0."""
    i, s = income_months.alias("i"), spend_months.alias("s")
    j = i.join(s, F.col("i.transaction_month") == F.col("s.transaction_month"), "full")
    return j.select(
        F.coalesce(F.col("i.transaction_month"), F.col("s.transaction_month")).alias("transaction_month"),
        F.coalesce(F.col("i.month_label"), F.lit(UNKNOWN_LABEL)).alias("month_label"),
        F.coalesce(F.col("i.year_number"), F.lit(0)).cast("long").alias("year_number"),
        F.coalesce(F.col("i.month_number"), F.lit(0)).cast("long").alias("month_number"),
        F.coalesce(F.col("i.quarter_number"), F.lit(0)).cast("long").alias("quarter_number"),
        F.coalesce(F.col("i.total_income"), F.lit(0.0)).alias("total_income"),
        F.coalesce(F.col("s.total_spend"), F.lit(0.0)).alias("total_spend"),
        F.coalesce(F.col("i.income_transaction_count"), F.lit(0)).cast("long").alias("income_transaction_count"),
        F.coalesce(F.col("s.spend_transaction_count"), F.lit(0)).cast("long").alias("spend_transaction_count"),
    )


# --------------------------------------------------------------------------
# spending statistics
# --------------------------------------------------------------------------

def agg_month_category(categorized: DataFrame) -> DataFrame:
    """Signed totals per calendar month and category over every debit-type row
    (transfers included, no start date)."""
    g = (categorized.filter(F.col("transaction_type") == F.lit("debit"))
         .groupBy(F.trunc(F.col("transaction_date"), "month").alias("month"), "category")
         .agg(*Money.of(F.col("amount")).sum().columns("_sum"),
              F.count(F.lit(1)).alias("transaction_count")))
    return _month_category_columns(g)


def mart_spending_stats(categorized: DataFrame, ordered: bool = True) -> DataFrame:
    """Per category: mean, median, spread and size of the monthly signed totals.

    The monthly totals are numbered within each category by a window (its
    partitions hold one row per active month, so they stay small whatever
    the data volume), and a single aggregation on the same partitioning then
    yields every statistic. The median is the exact interpolated one,
    ``lo + (hi - lo) * 0.5`` of the two middle values, which is what SQL's
    ``median`` computes.
    """
    return _stats_from(agg_month_category(categorized), ordered)


def _month_category_columns(g: DataFrame) -> DataFrame:
    total = Money.named("_sum").value()
    return g.select("month", "category", "_sum_d", "_sum_b", total.alias("total_spend"),
                    "transaction_count",
                    (total / F.col("transaction_count")).alias("avg_transaction"))


def _stats_from(m: DataFrame, ordered: bool) -> DataFrame:
    ranked = m.select("*",
                      F.row_number().over(Window.partitionBy("category").orderBy("total_spend")).alias("_rn"),
                      F.count(F.lit(1)).over(Window.partitionBy("category")).alias("_n"))
    lo_pos = F.floor((F.col("_n") - 1) / 2) + 1
    hi_pos = F.ceil((F.col("_n") - 1) / 2) + 1
    mean = Money.named("_sum").sum().value() / F.count(F.lit(1))
    sd = F.stddev_samp("total_spend")
    least, most = F.min("total_spend"), F.max("total_spend")
    lo = F.max(F.when(F.col("_rn") == lo_pos, F.col("total_spend")))
    hi = F.max(F.when(F.col("_rn") == hi_pos, F.col("total_spend")))
    out = ranked.groupBy("category").agg(
        round_half_away(mean).alias("mean_monthly_spend"),
        round_half_away(lo + (hi - lo) * F.lit(0.5)).alias("median_monthly_spend"),
        round_half_away(sd).alias("stddev_monthly_spend"),
        round_half_away(least).alias("min_monthly_spend"),
        round_half_away(most).alias("max_monthly_spend"),
        round_half_away(most - least).alias("spend_range"),
        round_half_away(safe_div(sd, mean), 4).alias("coefficient_of_variation"),
        F.sum("transaction_count").cast("long").alias("total_transactions"),
        round_half_away(F.avg("avg_transaction")).alias("avg_transaction_size"),
    )
    return out.orderBy(F.desc("mean_monthly_spend")) if ordered else out


# --------------------------------------------------------------------------
# all marts from one roll-up of the ledger
# --------------------------------------------------------------------------

def ledger_rollup(categorized: DataFrame, start_date: str = DEFAULT_START_DATE) -> DataFrame:
    """Everything the four marts need, aggregated in one pass.

    Grouped by month, category, income type (credits only), source and the
    flags the marts filter on; each group carries its money sums (absolute and
    signed), row count and smallest/largest amount. All keys have low
    cardinality (calendar months x categories x a few flags), so the result
    is small whatever the data volume, and every mart is a re-aggregation of
    it: one scan and one shuffle of partial aggregates for all four.
    """
    a = F.col("absolute_amount")
    return (categorized.groupBy(
                "transaction_month", "category",
                F.when(~F.col("is_debit"), income_type_expr(F.col("description"))).alias("income_type"),
                "source", "is_debit", "is_payment", "is_transfer",
                F.coalesce(F.col("transaction_type") == F.lit("debit"), F.lit(False)).alias("type_debit"),
                (F.col("transaction_date") >= _start(start_date)).alias("in_range"))
            .agg(*Money.of(a).sum().columns("_sum"),
                 F.count(F.lit(1)).alias("_n"),
                 F.min(a).alias("_min"),
                 F.max(a).alias("_max"),
                 *Money.of(F.col("amount")).sum().columns("_signed")))


def _regroup(r: DataFrame, dim: str) -> DataFrame:
    return (r.groupBy("transaction_month", dim, "source")
            .agg(*Money.named("_sum").sum().columns("_sum"),
                 F.sum("_n").cast("long").alias("transaction_count"),
                 F.min("_min").alias("_min"),
                 F.max("_max").alias("_max")))


def marts_from_rollup(rollup: DataFrame, start_date: str = DEFAULT_START_DATE,
                      ordered: bool = True) -> dict[str, DataFrame]:
    """The four marts from ``ledger_rollup`` (same rows as computing each
    mart from the ledger)."""
    r = rollup
    debit, payment, transfer = F.col("is_debit"), F.col("is_payment"), F.col("is_transfer")
    kept = ~payment & ~transfer & F.col("in_range")
    spend = _spend_windows(_regroup(r.filter(debit & kept), "category"), ordered)
    income = _income_windows(_regroup(r.filter(~debit & kept), "income_type"), ordered)
    groups = (r.filter(kept).groupBy("transaction_month",
                                     F.when(~debit, F.col("income_type")).otherwise(F.col("category")).alias("dim"),
                                     "source", (~debit).alias("is_income"))
              .agg(*Money.named("_sum").sum().columns("_sum"), F.sum("_n").alias("_n")))
    savings = savings_from_months(_months_from_groups(groups), start_date)
    if ordered:
        savings = savings.orderBy(F.desc("transaction_month"))
    m = (r.filter(F.col("type_debit"))
         .groupBy(F.col("transaction_month").alias("month"), "category")
         .agg(*Money.named("_signed").sum().columns("_sum"), F.sum("_n").cast("long").alias("transaction_count")))
    stats = _stats_from(_month_category_columns(m), ordered)
    return {"mart_monthly_spend": spend, "mart_income": income,
            "mart_savings_rate": savings, "mart_spending_stats": stats}
