"""The 40-row sample, end to end, against hand-derived values (start 2024-01-01)."""

import pytest
from pyspark.sql import functions as F

from tally.operators import quality
from tally.plans import marts
from tally.plans.models import ModelOptions, build_marts, int_categorized
from tally.schema import BANK, CARD
from tally.sources.files import read_csv_text, read_source
from tally.sources.loader import SourceFile, load_sources
from tally.sources.raw import RawStore, standardise
from tally.sources.snapshots import SnapshotStore

START = "2024-01-01"


@pytest.fixture(scope="module")
def ledger(spark, sample_paths):
    bank = standardise(read_source(spark, sample_paths["bank"], BANK))
    card = standardise(read_source(spark, sample_paths["card"], CARD))
    df = int_categorized(bank, card, ModelOptions(start_date=START)).cache()
    yield df
    df.unpersist()


def test_validation_report(spark, sample_paths):
    parts = []
    for spec in (BANK, CARD):
        df = read_csv_text(spark, sample_paths[spec.name])
        parts.append(quality.profile(spark, df, spec))
    res = parts[0].unionByName(parts[1])
    summary = {r["source"]: r for r in quality.summarise(res).collect()}
    for s in ("bank", "card"):
        assert summary[s]["passed"] and summary[s]["rows"] == 20
        assert summary[s]["errors"] == 0 and summary[s]["warnings"] == 1
    extra = {r["source"]: r["column"] for r in res.filter("check = 'extra_columns'").collect()}
    assert extra == {"bank": "balance", "card": "merchant_category,statement_balance"}
    assert summary["ALL"]["passed"] and summary["ALL"]["warnings"] == 2


def test_future_date_warning_with_early_as_of(spark, sample_paths):
    df = read_csv_text(spark, sample_paths["card"])
    res = quality.profile(spark, df, CARD, as_of=F.lit("2024-01-28").cast("timestamp_ntz"))
    fut = res.filter("check = 'future_dates'").first()
    assert fut["n_bad"] == 1 and fut["sample"] == ["CC-020"]


def test_load_twice_and_full_refresh(spark, sample_paths, scratch):
    store = RawStore(spark, scratch("raw"))
    files = [SourceFile("bank", sample_paths["bank"]), SourceFile("card", sample_paths["card"])]
    out, ok = load_sources(spark, store, files)
    assert ok and {r["source"]: r["rows_loaded"] for r in out.collect()} == {"bank": 20, "card": 20}
    out, ok = load_sources(spark, store, files)
    assert ok and {r["source"]: r["rows_loaded"] for r in out.collect()} == {"bank": 0, "card": 0}
    assert store.read("raw_bank_transactions").count() == 20
    out, ok = load_sources(spark, store, files, full_refresh=True)
    assert {r["source"]: r["rows_loaded"] for r in out.collect()} == {"bank": 20, "card": 20}
    assert store.read("raw_card_transactions").count() == 20


def test_flags(ledger):
    pay = {r["transaction_id"] for r in ledger.filter("is_payment").collect()}
    tr = {r["transaction_id"] for r in ledger.filter("is_transfer").collect()}
    assert pay == {"CC-011"} and tr == {"TXN-010", "TXN-016"}
    assert ledger.filter("is_debit").count() == 35


def test_savings(ledger):
    r = marts.mart_savings_rate(ledger, START).collect()
    assert len(r) == 1
    r = r[0]
    assert (r["total_income"], r["total_spend"], r["net_savings"]) == (6503.12, 2149.29, 4353.83)
    assert (r["savings_rate"], r["spending_rate"]) == (66.95, 33.05)
    assert r["financial_health_status"] == "Healthy" and r["is_surplus_month"]
    assert (r["income_transaction_count"], r["spend_transaction_count"], r["total_transaction_count"]) == (3, 34, 37)
    assert r["cumulative_savings"] == 4353.83
    assert r["mom_income_change"] is None and r["prior_month_savings_rate"] is None


def test_income(ledger):
    rows = {(r["income_type"], r["source"]): r for r in marts.mart_income(ledger, START).collect()}
    p = rows[("Payroll", "bank")]
    assert (p["total_income"], p["transaction_count"], p["avg_transaction_amount"],
            p["largest_transaction_amount"], p["pct_of_monthly_income"]) == (6500.0, 2, 3250.0, 3250.0, 99.95)
    i = rows[("Interest", "bank")]
    assert (i["total_income"], i["transaction_count"], i["pct_of_monthly_income"]) == (3.12, 1, 0.05)
    assert all(r["mom_income_change"] == 0 for r in rows.values())


EXPECTED_SPEND = [  # rank, category, source, total, n, min, max, share
    (1, "Shopping", "card", 311.07, 3, 67.32, 129.99, 14.47),
    (2, "Groceries", "bank", 310.57, 4, 47.62, 112.34, 14.45),
    (3, "Travel", "card", 284.00, 1, 284.00, 284.00, 13.21),
    (4, "Groceries", "card", 281.64, 2, 94.21, 187.43, 13.10),
    (5, "Other", "bank", 224.50, 2, 100.00, 124.50, 10.45),
    (6, "Insurance", "bank", 142.00, 1, 142.00, 142.00, 6.61),
    (7, "Dining", "card", 137.64, 5, 6.85, 67.40, 6.40),
    (8, "Utilities", "bank", 89.99, 1, 89.99, 89.99, 4.19),
    (9, "Subscriptions", "card", 75.97, 3, 2.99, 54.99, 3.53),
    (10, "Transport", "bank", 72.70, 2, 18.50, 54.20, 3.38),
    (11, "Transport", "card", 62.35, 2, 14.25, 48.10, 2.90),
    (12, "Health", "card", 53.65, 2, 22.47, 31.18, 2.50),
    (13, "Shopping", "bank", 34.99, 1, 34.99, 34.99, 1.63),
    (14, "Subscriptions", "bank", 25.98, 2, 9.99, 15.99, 1.21),
    (15, "Fitness", "bank", 24.99, 1, 24.99, 24.99, 1.16),
    (16, "Dining", "bank", 13.75, 1, 13.75, 13.75, 0.64),
    (17, "Fees", "card", 3.50, 1, 3.50, 3.50, 0.16),
]


def test_monthly_spend(ledger):
    got = marts.mart_monthly_spend(ledger, START).collect()
    assert [(r["category_spend_rank"], r["category"], r["source"], r["total_spend"], r["transaction_count"],
             r["min_transaction_amount"], r["max_transaction_amount"], r["pct_of_monthly_spend"])
            for r in got] == EXPECTED_SPEND
    assert all(r["mom_spend_change"] == 0 for r in got)
    avg = {(r["category"], r["source"]): r["avg_transaction_amount"] for r in got}
    assert abs(avg[("Transport", "card")] - 31.175) <= 0.01 and abs(avg[("Health", "card")] - 26.825) <= 0.01
    assert avg[("Groceries", "bank")] == 77.64 and avg[("Dining", "card")] == 27.53


def test_spending_stats(ledger):
    got = marts.mart_spending_stats(ledger).collect()
    assert [(r["category"], r["mean_monthly_spend"], r["total_transactions"]) for r in got] == [
        ("Fees", -3.5, 1), ("Fitness", -24.99, 1), ("Health", -53.65, 2), ("Utilities", -89.99, 1),
        ("Subscriptions", -101.95, 5), ("Transport", -135.05, 4), ("Insurance", -142.0, 1),
        ("Dining", -151.39, 6), ("Travel", -284.0, 1), ("Shopping", -346.06, 4),
        ("Groceries", -592.21, 6), ("Other", -724.5, 3)]
    for r in got:
        assert r["mean_monthly_spend"] == r["median_monthly_spend"] == r["min_monthly_spend"] == r["max_monthly_spend"]
        assert r["stddev_monthly_spend"] is None and r["coefficient_of_variation"] is None
        assert r["spend_range"] == 0


def test_build_marts_reuses_ledger(spark, sample_paths):
    bank = standardise(read_source(spark, sample_paths["bank"], BANK))
    card = standardise(read_source(spark, sample_paths["card"], CARD))
    out = build_marts(bank, card, ModelOptions(start_date=START))
    try:
        assert out["mart_savings_rate"].count() == 1
        assert out["mart_monthly_spend"].count() == 17
        assert out["mart_income"].count() == 2
        assert out["mart_spending_stats"].count() == 12
    finally:
        out["_rollup"].unpersist()


def test_batch_job_end_to_end(spark, sample_paths, scratch):
    from tally.plans.job import run
    from tally.plans.models import register_views
    marts_root = scratch("marts")
    out = run(spark, sample_paths["bank"], sample_paths["card"], scratch("raw"), marts_root, START)
    assert out == {"all_loaded": True, "tests_passed": True, "validation_passed": True}
    sav = SnapshotStore(spark, marts_root).read("mart_savings_rate").first()
    assert (sav["total_income"], sav["total_spend"]) == (6503.12, 2149.29)
    bank = standardise(read_source(spark, sample_paths["bank"], BANK))
    card = standardise(read_source(spark, sample_paths["card"], CARD))
    register_views(bank, card, ModelOptions(start_date=START))
    assert spark.sql("SELECT count(*) AS n FROM int_categorized WHERE is_payment").first()["n"] == 1


def test_validation_report_dispatch(spark, sample_paths, tmp_path):
    res, summ = quality.validation_report(
        spark, {"bank": sample_paths["bank"], "card": str(tmp_path / "absent.csv"), "cash": "x"})
    by = {r["source"]: r for r in summ.collect()}
    assert by["bank"]["passed"] and not by["card"]["passed"] and not by["cash"]["passed"]
    assert not by["ALL"]["passed"] and by["ALL"]["errors"] == 2
