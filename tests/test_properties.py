"""Property tests: Spark results against brute force on generated inputs."""

import datetime as dt
import statistics

import duckdb
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import raw_frame
from tally.functions.numeric import round_half_away
from tally.operators.rules import (
    DEFAULT_RULE_GROUPS,
    FALLBACK_CATEGORY,
    categorize,
    categorize_with_rule_table,
    category_expr,
    read_rules,
    rules_frame,
)
from tally.plans import marts
from tally.plans.models import ModelOptions, int_categorized

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
HEAVY = settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))

KEYWORDS = [kw for _, kws in DEFAULT_RULE_GROUPS for kw in kws]
FRAGMENTS = KEYWORDS + ["COFFEE", "STORE", "#123", "PAYMENT", "x", " ", "PLANET", "UBER", "EATS"]


def first_match(text: str) -> str:
    for category, kws in DEFAULT_RULE_GROUPS:
        if any(kw in text for kw in kws):
            return category
    return FALLBACK_CATEGORY


descriptions = st.lists(st.lists(st.sampled_from(FRAGMENTS), min_size=1, max_size=4)
                        .map(lambda parts: " ".join(parts).upper()), min_size=1, max_size=150)


@SETTINGS
@given(descriptions)
def test_category_is_first_matching_rule(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "description string")
    got = [r[0] for r in df.select(category_expr("description", None)).collect()]
    assert got == [first_match(t) for t in texts]


money = st.integers(min_value=-10_000_000, max_value=10_000_000).map(lambda c: c / 100.0)
divisors = st.sampled_from([1.0, 3.0, 7.0, 9.0, 11.0, 13.0, 100.0])


@SETTINGS
@given(st.lists(st.tuples(money, divisors), min_size=1, max_size=200))
def test_rounding_matches_sql_round(spark, pairs):
    df = spark.createDataFrame(pairs, "a double, b double")
    got = [(r[0], r[1]) for r in df.select(round_half_away(F.col("a") / F.col("b")),
                                           round_half_away(F.col("a") / F.col("b"), 4)).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT round(?::double / ?::double, 2), round(?::double / ?::double, 4)",
                        [a, b, a, b]).fetchone() for a, b in pairs]
    assert got == [tuple(w) for w in want]


months = st.lists(st.tuples(st.integers(1, 12), st.integers(1, 50_000)), min_size=1, max_size=40)


@HEAVY
@given(months)
def test_median_and_mean_against_brute_force(spark, rows):
    data = [(f"i{i}", f"2024-{m:02d}-10", "KROGER", -c / 100.0, "debit") for i, (m, c) in enumerate(rows)]
    led = int_categorized(raw_frame(spark, data, "bank"), raw_frame(spark, [], "card"),
                          ModelOptions(start_date="2024-01-01"))
    got = marts.mart_spending_stats(led).first()
    per_month: dict[int, int] = {}
    for m, c in rows:
        per_month[m] = per_month.get(m, 0) - c
    totals = sorted(v / 100.0 for v in per_month.values())
    con = duckdb.connect()
    med, mean = con.execute("SELECT round(median(x), 2), round(sum(x::decimal(18,2))::double / count(*), 2) "
                            "FROM (SELECT unnest(?::double[]) AS x)", [totals]).fetchone()
    assert got["median_monthly_spend"] == med and got["mean_monthly_spend"] == mean
    assert got["total_transactions"] == len(rows)
    assert abs(got["median_monthly_spend"] - statistics.median(totals)) <= 0.0051


ledger_rows = st.lists(st.tuples(st.integers(1, 6), st.sampled_from(
    ["PAYROLL", "KROGER", "TRANSFER", "INTEREST PAYMENT", "NETFLIX", "REFUND", "PAYMENT THANK YOU"]),
    st.integers(-30_000, 30_000), st.booleans()), min_size=1, max_size=60)


@HEAVY
@given(ledger_rows)
def test_single_pass_savings_equals_join_form(spark, rows):
    bank = [(f"b{i}", f"2024-{m:02d}-03", d, c / 100.0, "credit" if c > 0 else "debit")
            for i, (m, d, c, card) in enumerate(rows) if not card]
    card = [(f"c{i}", f"2024-{m:02d}-04", d, -c / 100.0, "debit" if c < 0 else "credit")
            for i, (m, d, c, is_card) in enumerate(rows) if is_card]
    led = int_categorized(raw_frame(spark, bank, "bank"), raw_frame(spark, card, "card"),
                          ModelOptions(start_date="2024-01-01"))
    fast = {r["transaction_month"]: r for r in marts.mart_savings_rate(led, "2024-01-01").collect()}
    joined = marts.join_months_full_outer(
        marts.rollup_income_month(marts.mart_income(led, "2024-01-01")),
        marts.rollup_spend_month(marts.mart_monthly_spend(led, "2024-01-01"))).collect()
    assert set(fast) == {r["transaction_month"] for r in joined}
    for r in joined:
        f = fast[r["transaction_month"]]
        assert (f["total_income"], f["total_spend"]) == (r["total_income"], r["total_spend"])
        assert (f["month_label"], f["year_number"]) == (r["month_label"], r["year_number"])
        assert (f["income_transaction_count"], f["spend_transaction_count"]) == (
            r["income_transaction_count"], r["spend_transaction_count"])
    assert all(isinstance(m, dt.date) for m in fast)


@pytest.mark.parametrize("filler", [0, 300])
def test_rules_mean_the_same_at_any_number(spark, filler):
    """Odd rules (empty, null, tied, another case) below and above the size at which a join takes over."""
    odd = [(5, "", "Everything"), (4, None, "Nothing"), (3, "cafe", "B"), (3, "cafe", "A"), (3, "CAF", "Tie by keyword"),
           (1, "zürich", None), (2, "ZÜRICH", "City"), (None, "bar", "No priority"), (7, "bar", "Late"), (6, "it's \\", "Quoted")]
    rules = odd + [(100 + k, f"FILLER{k:04d}", f"F{k}") for k in range(filler)]
    texts = ["CAFE BAR", "ABC", "ZÜRICH BAR", "BAR", "IT'S \\ HERE", "", None]
    ledger = spark.createDataFrame([(t, None) for t in texts], "description string, provider_category string")
    for form in (categorize(ledger, rules), categorize_with_rule_table(ledger, rules_frame(spark, rules))):
        got = {r["description"]: r["category"] for r in form.collect()}
        assert got == {"CAFE BAR": "Tie by keyword", "ABC": "Other", "ZÜRICH BAR": "City", "BAR": "Late",
                       "IT'S \\ HERE": "Quoted", "": "Other", None: "Other"}
    assert {r["category"] for r in categorize(ledger, []).collect()} == {"Other"}


def test_seed_order_over_files(spark, tmp_path):
    """Lines of several files take their order from the files' names, not from how Spark packs them."""
    (tmp_path / "2.csv").write_text("keyword,category\nAAAA,Second\n" + "".join(f"X{k:05d},Long file\n" for k in range(3000)))
    (tmp_path / "1.csv").write_text("keyword,category\nBBBB,First\nAAAA CC,First too\n")
    ledger = spark.createDataFrame([("AAAA BBBB",), ("AAAA CC",), ("X00007",), ("AAAA",)], "description string")
    ledger = ledger.withColumn("provider_category", F.lit(None).cast("string"))
    got = {r[0]: r[1] for r in categorize_with_rule_table(ledger, read_rules(spark, str(tmp_path)))
           .select("description", "category").collect()}
    assert got == {"AAAA BBBB": "First", "AAAA CC": "First too", "X00007": "Long file", "AAAA": "Second"}
