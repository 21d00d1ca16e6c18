"""Invariants that hold for any input: equal plans, shares, idempotent loads."""

import os

import pytest
from pyspark.sql import functions as F

from tally.plans import marts
from tally.queries import START, categorized, q_load_incremental
from tally.plans.models import raw_bank_from_tables, raw_card_from_tables
from tally.sources.raw import RawStore

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def ledger(spark):
    df = categorized(spark, SF).cache()
    yield df
    df.unpersist()  # later plans must read the tables, not this cache


def test_single_pass_savings_equals_full_outer_join(ledger):
    months = marts.join_months_full_outer(
        marts.rollup_income_month(marts.mart_income(ledger, START)),
        marts.rollup_spend_month(marts.mart_monthly_spend(ledger, START)))
    fast = marts.monthly_activity(ledger, START).collect()
    lit = {r["transaction_month"]: (r["total_income"], r["total_spend"], r["income_transaction_count"],
                                    r["spend_transaction_count"]) for r in months.collect()}
    got = {r["transaction_month"]: (float(r["_i_d"] or 0), float(r["_s_d"] or 0), r["income_n"], r["spend_n"])
           for r in fast}
    assert got == lit


def test_shares_sum_to_100(ledger):
    spend = marts.mart_monthly_spend(ledger, START)
    sums = spend.groupBy("transaction_month").agg(F.sum("pct_of_monthly_spend").alias("s")).collect()
    assert all(abs(r["s"] - 100.0) < 0.01 * 40 for r in sums)
    inc = marts.mart_income(ledger, START)
    sums = inc.groupBy("transaction_month").agg(F.sum("pct_of_monthly_income").alias("s")).collect()
    assert all(abs(r["s"] - 100.0) < 0.01 * 10 for r in sums)


def test_spend_plus_excluded_equals_all_debits(ledger):
    debits = ledger.filter("is_debit AND transaction_date >= DATE'1996-01-01'").count()
    spend = marts.spend_rows(ledger, START).count()
    excluded = ledger.filter("is_debit AND transaction_date >= DATE'1996-01-01' AND "
                             "(is_payment OR is_transfer OR category = 'Income')").count()
    assert spend + excluded == debits


def test_loading_twice_equals_loading_once(spark, scratch):
    store = RawStore(spark, scratch("raw"))
    bank = raw_bank_from_tables(spark, SF)
    first = store.load(bank, "b")
    second = store.load(bank, "b")
    assert first.rows_loaded == bank.count() and second.rows_loaded == 0
    assert store.read("b").count() == bank.count()


def test_incremental_keeps_stored_rows(spark):
    out = q_load_incremental(spark, SF)
    revised = out.filter(F.col("description").endswith("(REVISED)")).collect()
    assert revised and all(r["transaction_id"].split("-")[0].endswith("0") for r in revised)
    assert out.count() == raw_bank_from_tables(spark, SF).count() + raw_card_from_tables(spark, SF).count()


@pytest.mark.parametrize("start", [START, "1996-01-15"])
def test_marts_from_one_rollup_equal_direct_marts(spark, start):
    from tally.plans.models import ModelOptions, build_marts
    bank, card = raw_bank_from_tables(spark, SF), raw_card_from_tables(spark, SF)
    out = build_marts(bank, card, ModelOptions(start_date=start))
    try:
        led = categorized(spark, SF)
        direct = {
            "mart_monthly_spend": marts.mart_monthly_spend(led, start),
            "mart_income": marts.mart_income(led, start),
            "mart_savings_rate": marts.mart_savings_rate(led, start),
            "mart_spending_stats": marts.mart_spending_stats(led),
        }
        for name, df in direct.items():
            a = [tuple(r) for r in out[name].collect()]
            b = [tuple(r) for r in df.collect()]
            assert out[name].columns == df.columns, name
            assert sorted(a, key=repr) == sorted(b, key=repr), name
    finally:
        out["_rollup"].unpersist()
