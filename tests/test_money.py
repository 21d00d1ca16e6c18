"""Money beyond two decimals and beyond the usual size; rounding; the rule table's own values."""

import math

import pytest
from pyspark.sql import functions as F

from tests.test_edges import ledger_of
from tally.functions.numeric import Money, round_half_away
from tally.operators.rules import DEFAULT_RULE_GROUPS
from tally.plans import marts

START = "2024-01-01"


def test_parts_of_a_cent_add_up(spark):
    rows = [(f"i{k}", "2024-01-05", "KROGER", -0.004, "debit") for k in range(1000)]
    led = ledger_of(spark, rows)
    spend = marts.mart_monthly_spend(led, START).first()
    assert (spend["total_spend"], spend["avg_transaction_amount"]) == (4.0, 0.0)
    assert marts.mart_spending_stats(led).first()["mean_monthly_spend"] == -4.0
    assert marts.mart_savings_rate(led, START).first()["total_spend"] == 4.0


def test_monthly_sides_add_the_marts_rounded_totals(spark):
    rows = [("a", "2024-01-05", "KROGER", -0.004, "debit"), ("b", "2024-01-05", "NETFLIX", -0.004, "debit"),
            ("c", "2024-01-06", "PAYROLL", 1.006, "credit"), ("d", "2024-01-06", "REFUND", 1.006, "credit")]
    led = ledger_of(spark, rows)
    one = marts.mart_savings_rate(led, START).first()
    assert (one["total_spend"], one["total_income"]) == (0.0, 2.02)
    out = marts.marts_from_rollup(marts.ledger_rollup(led, START), START)
    assert out["mart_savings_rate"].first() == one


def test_huge_amounts_do_not_stop_the_marts(spark):
    rows = [("a", "2024-01-05", "KROGER", -1e300, "debit"), ("b", "2024-01-06", "KROGER", -1e300, "debit"),
            ("c", "2024-01-06", "KROGER", -5.25, "debit"), ("d", "2024-02-06", "KROGER", -1.5, "debit"),
            ("e", "2024-02-07", "PAYROLL", 1e15, "credit")]
    led = ledger_of(spark, rows)
    got = {r["month_number"]: r["total_spend"] for r in marts.mart_monthly_spend(led, START).collect()}
    assert got == {1: 2e300, 2: 1.5}
    assert {r["month_number"]: r["total_income"] for r in marts.mart_income(led, START).collect()} == {2: 1e15}
    assert marts.mart_savings_rate(led, START).count() == 2
    assert marts.mart_spending_stats(led).count() == 1


@pytest.mark.parametrize("places", [2, 4])
def test_rounding_has_no_largest_value(spark, places):
    values = [1e17, -1e17, 1e15, 9.22e18, 1e300, 0.005, -0.005, 2.675, 1.005, 123456789.12345, 0.0, float("inf")]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r[0] for r in df.select(round_half_away("v", places)).collect()]
    for v, g in zip(values, got):
        scaled = abs(v) * 10 ** places
        want = v if not scaled < 2 ** 52 else math.copysign(math.floor(scaled + 0.5) / 10 ** places, v)
        assert g == want
    assert math.isnan(spark.range(1).select(round_half_away(F.lit(float("nan")))).first()[0])


def test_exact_whatever_the_order(spark):
    values = [0.1, 0.2, 0.3, 1e10, -1e10, 0.000001] * 50
    for parts in (1, 7):
        df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        assert df.agg(Money.of(F.col("v")).sum().value()).first()[0] == 30.00005


def test_rules_by_their_own_values():
    # The default rule table.
    assert DEFAULT_RULE_GROUPS == [
        ("Groceries", ["WALMART", "KROGER", "WHOLEFDS", "WHOLE FOODS", "PUBLIX", "TRADER JOE", "ALDI", "COSTCO",
                       "SAM'S CLUB", "TARGET"]),
        ("Dining", ["MCDONALD", "CHIPOTLE", "STARBUCKS", "CHICK-FIL-A", "CHICK FIL A", "OLIVE GARDEN", "CHEESECAKE",
                    "SUBWAY", "DOMINO", "PIZZA", "DOORDASH", "GRUBHUB", "UBER EATS", "PANERA", "TACO BELL"]),
        ("Transport", ["SHELL", "CHEVRON", "BP OIL", "RACETRAC", "EXXON", "SUNOCO", "UBER", "LYFT", "PARKING", "SUNPASS",
                       "TOLL"]),
        ("Subscriptions", ["NETFLIX", "SPOTIFY", "HULU", "DISNEY", "APPLE.COM/BILL", "AMAZON PRIME", "YOUTUBE", "ADOBE",
                           "MICROSOFT", "DROPBOX"]),
        ("Utilities", ["ELECTRIC", "FPL", "DUKE ENERGY", "COMCAST", "AT&T", "VERIZON", "T-MOBILE", "WATER", "INTERNET",
                       "XFINITY"]),
        ("Insurance", ["PROGRESSIVE", "GEICO", "STATE FARM", "ALLSTATE", "INSURANCE"]),
        ("Health", ["CVS", "WALGREENS", "PHARMACY", "DOCTOR", "MEDICAL", "DENTAL", "OPTUM"]),
        ("Fitness", ["PLANET FITNESS", "GOLD'S GYM", "LA FITNESS", "GYM", "PELOTON"]),
        ("Shopping", ["AMAZON", "BEST BUY", "HOME DEPOT", "LOWES", "IKEA", "WAYFAIR", "EBAY"]),
        ("Travel", ["DELTA", "UNITED AIR", "AMERICAN AIR", "SOUTHWEST", "MARRIOTT", "HILTON", "AIRBNB", "HOTEL"]),
        ("Income", ["PAYROLL", "DIRECT DEPOSIT", "INTEREST PAYMENT"]),
        ("Fees", ["FEE", "FOREIGN TRANSACTION", "LATE PAYMENT", "OVERDRAFT"]),
    ]
    assert marts.INCOME_TYPE_RULES == [
        ("Payroll", ["PAYROLL", "DIRECT DEPOSIT"]), ("Interest", ["INTEREST"]), ("Refund", ["REFUND", "RETURN", "CREDIT"]),
        ("Peer transfer", ["VENMO", "ZELLE", "CASHAPP"]), ("Rewards", ["CASHBACK", "REWARDS"])]


def test_no_small_amount_is_cut(spark):
    rows = [(4e-7,)] * 1000 + [(0.1,), (None,)]
    df = spark.createDataFrame(rows, "a double").repartition(5)
    total = df.agg(*Money.of(F.col("a")).sum().columns("s")).select(Money.named("s").value()).first()[0]
    assert total == pytest.approx(0.1004, rel=1e-12)
    exact = spark.createDataFrame([(k / 100,) for k in range(10_000)], "a double").agg(
        *Money.of(F.col("a")).sum().columns("s")).first()
    assert exact["s_b"] == 0.0 and float(exact["s_d"]) == 499_950.0
