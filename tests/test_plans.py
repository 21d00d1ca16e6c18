"""Plan regression tests: pushdown, no duplicated rule CASE, no joins in marts."""

import contextlib
import io
import os
import re

import pytest

from tally.plans.marts import INCOME_TYPE_RULES
from tally.queries import QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def plan_of(spark, key):
    """The formatted plan: every node's details printed in full (the one-line
    plan string abbreviates long scan descriptions)."""
    df = QUERIES[key](spark, SF)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue(), df


def test_start_date_reaches_both_scans(spark):
    for key in ("mart_savings_rate", "mart_monthly_spend", "mart_income", "spend_rows"):
        plan, _ = plan_of(spark, key)
        assert "GreaterThanOrEqual(o_orderdate,1996-01-01" in plan, key
        assert "GreaterThanOrEqual(l_shipdate,1996-01-01" in plan, key


def test_rule_case_is_not_copied_into_filters(spark):
    base, _ = plan_of(spark, "categorize")
    n_rules = base.count("Contains(")
    # The savings mart also types income, once per row of either source.
    income = 2 * sum(len(words) for _, words in INCOME_TYPE_RULES)
    for key in ("spend_rows", "agg_spend", "mart_monthly_spend", "mart_savings_rate"):
        plan, _ = plan_of(spark, key)
        assert plan.count("Contains(") <= n_rules + 10 + (income if key == "mart_savings_rate" else 0), key


def test_marts_have_no_joins_and_flagship_moves_rows_once(spark):
    for key in ("mart_monthly_spend", "mart_income", "mart_savings_rate", "mart_spending_stats"):
        plan, _ = plan_of(spark, key)
        assert not re.search(r"SortMergeJoin|BroadcastHashJoin|BroadcastNestedLoopJoin|CartesianProduct", plan), key
    plan, _ = plan_of(spark, "mart_savings_rate")
    hash_exchanges = re.findall(r"Arguments: hashpartitioning\(([^)]*)\)", plan)
    # Rows are exchanged once, grouped; the marts' rounded totals (a few a month) once more, by month alone.
    by_month = [h for h in hash_exchanges if "transaction_month" in h]
    assert len(by_month) == 2 and "source" in by_month[0] and "source" not in by_month[1]


def test_scans_read_only_needed_columns(spark):
    plan, _ = plan_of(spark, "mart_savings_rate")
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", plan) or re.findall(r"\[([^\]]*)\] Batched", plan)
    text = " ".join(schemas) if schemas else plan
    for unused in ("o_custkey", "o_orderstatus", "l_quantity", "l_discount", "l_returnflag"):
        assert unused not in text


@pytest.mark.parametrize("key", ["rollup_spend_month", "win_lag_spend", "int_categorized"])
def test_rules_are_looked_up_once_a_row_by_code_that_is_compiled(spark, key):
    before = spark.conf.get("spark.sql.codegen.hugeMethodLimit"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")  # Spark's default: larger methods are generated
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        code, plan = io.StringIO(), io.StringIO()
        with contextlib.redirect_stdout(code):
            QUERIES[key](spark, SF).explain("codegen")
        with contextlib.redirect_stdout(plan):
            QUERIES[key](spark, SF).explain()
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", before[0])
        spark.conf.set("spark.sql.adaptive.enabled", before[1])
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code.getvalue())]
    assert sizes and max(sizes) < 8_000  # the JVM compiles no larger method
    assert plan.getvalue().count("GEICO") == 2  # once for each source, not in the scans' filters too


def test_rules_keep_their_order(spark):
    from tally.operators.rules import categorize
    hits = spark.createDataFrame([("UBER EATS",), ("UBER TRIP",), ("AMAZON PRIME",), ("SHELL",), ("x",), (None,)], "description string")
    got = {r["description"]: r["category"] for r in categorize(hits, use_provider=False).collect()}
    assert got == {"UBER EATS": "Dining", "UBER TRIP": "Transport", "AMAZON PRIME": "Subscriptions", "SHELL": "Transport",
                   "x": "Other", None: "Other"}
