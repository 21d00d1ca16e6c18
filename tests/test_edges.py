"""Inline edge fixtures: band edges, gaps, ties, precedence, early exits."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import raw_frame
from tally.operators import quality
from tally.operators.rules import category_expr, categorize, default_rules, read_rules, rules_frame, \
    categorize_with_rule_table
from tally.plans import marts
from tally.plans.models import ModelOptions, int_all_transactions, int_categorized
from tally.schema import BANK, CARD
from tally.sources.files import file_readiness, read_csv_text, write_csv
from tally.sources.loader import SourceFile, load_sources
from tally.sources.raw import RawStore, standardise
from tally.streaming.incremental import stream_load

START = "2024-01-01"


def ledger_of(spark, bank_rows, card_rows=(), opts=ModelOptions(start_date=START)):
    bank = raw_frame(spark, list(bank_rows), "bank")
    card = raw_frame(spark, list(card_rows), "card")
    return int_categorized(bank, card, opts)


def savings(spark, bank_rows, card_rows=(), start=START):
    return {r["transaction_month"]: r for r in
            marts.mart_savings_rate(ledger_of(spark, bank_rows, card_rows), start).collect()}


def test_spend_only_and_income_only_months(spark):
    s = savings(spark, [("a", "2024-01-05", "KROGER", -10.0, "debit"),
                        ("b", "2024-02-05", "PAYROLL", 100.0, "credit")])
    jan, feb = s[dt.date(2024, 1, 1)], s[dt.date(2024, 2, 1)]
    assert (jan["month_label"], jan["year_number"], jan["month_number"], jan["quarter_number"]) == ("Unknown", 0, 0, 0)
    assert jan["total_income"] == 0 and jan["savings_rate"] is None
    assert jan["financial_health_status"] == "No income data" and not jan["is_surplus_month"]
    assert (feb["total_spend"], feb["savings_rate"], feb["financial_health_status"]) == (0, 100.0, "Healthy")
    assert feb["month_label"] == "Feb 2024"
    assert feb["cumulative_savings"] == 90.0 and feb["mom_income_change"] == 100.0


@pytest.mark.parametrize("spend,band", [(80.0, "Healthy"), (95.0, "On track"), (100.0, "Tight"),
                                        (100.01, "Deficit"), (81.0, "On track"), (96.0, "Tight")])
def test_health_band_edges(spark, spend, band):
    s = savings(spark, [("i", "2024-03-01", "PAYROLL", 100.0, "credit"),
                        ("s", "2024-03-02", "KROGER", -spend, "debit")])
    assert s[dt.date(2024, 3, 1)]["financial_health_status"] == band


def test_lag_uses_previous_present_month_and_rank_ties(spark):
    rows = [("a", "2024-01-05", "KROGER", -10.0, "debit"),
            ("b", "2024-03-05", "KROGER", -25.0, "debit"),
            ("c", "2024-03-06", "NETFLIX", -25.0, "debit"),
            ("d", "2024-03-07", "SHELL", -5.0, "debit")]
    got = marts.mart_monthly_spend(ledger_of(spark, rows), START).collect()
    by = {(r["transaction_month"], r["category"]): r for r in got}
    mar = dt.date(2024, 3, 1)
    assert by[(mar, "Groceries")]["mom_spend_change"] == 15.0      # vs January, not February
    assert by[(mar, "Subscriptions")]["mom_spend_change"] == 0.0    # first row: coalesced
    assert by[(mar, "Groceries")]["category_spend_rank"] == 1
    assert by[(mar, "Subscriptions")]["category_spend_rank"] == 1
    assert by[(mar, "Transport")]["category_spend_rank"] == 3       # gap after the tie
    shares = sum(r["pct_of_monthly_spend"] for r in got if r["transaction_month"] == mar)
    assert abs(shares - 100.0) < 0.05


def test_zero_amounts_are_income_rows(spark):
    led = ledger_of(spark, [("z", "2024-01-02", "MYSTERY", 0.0, "debit")],
                    [("z", "2024-01-02", "MYSTERY", 0.0, "debit")])
    rows = led.collect()
    assert all(not r["is_debit"] for r in rows)
    assert {r["unique_transaction_id"] for r in rows} == {"bank-z", "card-z"}  # same id, both kept
    inc = marts.mart_income(led, START).collect()
    assert sum(r["transaction_count"] for r in inc) == 2
    df = spark.createDataFrame([("z", "2024-01-02", "X", "0", "debit")], ",".join(
        f"{c} string" for c in BANK.required))
    res = {r["check"]: r["n_bad"] for r in quality.row_checks(df, BANK).collect()}
    assert res["zero_amounts"] == 1


def test_bank_credit_saying_payment_is_income(spark):
    led = ledger_of(spark, [("p", "2024-01-02", "ONLINE PAYMENT THANK YOU", 50.0, "credit")])
    r = led.first()
    assert not r["is_payment"]
    assert marts.mart_income(led, START).first()["total_income"] == 50.0


def test_provider_category_priority(spark):
    card = spark.createDataFrame(
        [("1", "UBER EATS", ""), ("2", "UBER EATS", "Unknown"), ("3", "UBER EATS", None),
         ("4", "UBER EATS", "Dining"), ("5", "KROGER", "Other")],
        "unique_transaction_id string, description string, provider_category string")
    got = {r["unique_transaction_id"]: r["category"] for r in categorize(card).collect()}
    assert got == {"1": "Dining", "2": "Dining", "3": "Dining", "4": "Dining", "5": "Other"}
    flags = {r["unique_transaction_id"]: r["is_uncategorised"] for r in categorize(card).collect()}
    assert flags["5"] is True  # a provider saying 'Other' counts as uncategorised


def test_rule_precedence_and_substrings(spark):
    df = spark.createDataFrame([(d,) for d in ["UBER EATS 123", "UBER *TRIP", "AMAZON PRIME VIDEO",
                                               "AMAZON.COM", "COFFEE HOUSE", "FLORIDA POWER & LIGHT",
                                               "HOME DEPOT #0451"]], "description string")
    got = [r[0] for r in df.select(category_expr("description", None)).collect()]
    assert got == ["Dining", "Transport", "Subscriptions", "Shopping", "Fees", "Other", "Shopping"]


def test_rule_table_forms_agree(spark):
    texts = ["UBER EATS", "COFFEE", "NOTHING", "AMAZON PRIME", "GYM", "LATE PAYMENT FEE", "", None, "X BP OIL"]
    led0 = int_all_transactions(raw_frame(spark, [(f"a{i}", "2024-01-02", d, -1.0, "debit") for i, d in
                                                  enumerate(texts)], "bank"), raw_frame(spark, [], "card"))
    joined = {r["description"]: r["category"] for r in categorize_with_rule_table(led0, rules_frame(spark)).collect()}
    case = {r["description"]: r["category"] for r in categorize(led0).collect()}
    assert joined == case and len(joined) == len(texts)
    assert joined["UBER EATS"] == "Dining" and joined["NOTHING"] == "Other" and joined["LATE PAYMENT FEE"] == "Fees"
    assert len(default_rules()) == 95


@pytest.mark.parametrize("n", [5_000, 20_000])
def test_long_rule_lists(spark, n):
    """Any number of rules: the join finds the first rule in the list that a text contains."""
    rules = [(k + 1, f"KW{(k * 7919) % n:05d}", f"c{k % 50}") for k in range(n)] + [(n + 1, "Z", "last")]
    texts = [f"SHOP KW{k:05d} AND KW{(k * 3) % n:05d} Z" for k in range(0, n, n // 40)] + ["NONE", "ZOO", None]
    df = spark.createDataFrame([(t, None) for t in texts], "description string, provider_category string")
    got = {r["description"]: r["category"] for r in categorize(df, rules).collect()}
    place = {kw: (p, c) for p, kw, c in rules}
    for t in texts:
        hits = sorted(place[w] for w in place if t and w in t)
        assert got[t] == (hits[0][1] if hits else "Other")


def test_seed_without_priorities_keeps_its_order(spark, tmp_path):
    seed = tmp_path / "rules.csv"
    seed.write_text('keyword,category\nUBER EATS,Food\nUBER,Rides\n"A ""B"", C",Quoted\nEATS,Never\n')
    rules = read_rules(spark, str(seed))
    df = spark.createDataFrame([(t, None) for t in ["UBER EATS", "UBER X", 'A "B", C', "EATS"]],
                               "description string, provider_category string")
    got = [r["category"] for r in categorize_with_rule_table(df, rules).orderBy("description").collect()]
    assert got == ["Quoted", "Never", "Food", "Rides"]


def test_refund_beats_rewards(spark):
    r = spark.range(1).select(marts.income_type_expr(F.lit("CREDIT CARD CASHBACK")).alias("t")).first()
    assert r["t"] == "Refund"
    r = spark.range(1).select(marts.income_type_expr(F.lit("VENMO CASHOUT")).alias("t")).first()
    assert r["t"] == "Peer transfer"


def test_mid_month_start(spark):
    rows = [("a", "2024-01-10", "KROGER", -10.0, "debit"), ("b", "2024-01-20", "KROGER", -20.0, "debit"),
            ("c", "2024-02-03", "KROGER", -30.0, "debit")]
    led = ledger_of(spark, rows, opts=ModelOptions(start_date="2024-01-15"))
    spend = marts.mart_monthly_spend(led, "2024-01-15").collect()
    assert {r["transaction_month"]: r["total_spend"] for r in spend} == {
        dt.date(2024, 1, 1): 20.0, dt.date(2024, 2, 1): 30.0}
    sav = marts.mart_savings_rate(led, "2024-01-15").collect()
    assert [r["transaction_month"] for r in sav] == [dt.date(2024, 2, 1)]
    assert sav[0]["mom_spend_change"] is None  # the dropped month does not feed the lag


def test_median_and_single_month(spark):
    rows = [(f"m{m}", f"2024-{m:02d}-05", "KROGER", float(m), "debit") for m in (1, 2, 10, 11)]
    rows.append(("x", "2024-01-05", "NETFLIX", 7.0, "debit"))
    stats = {r["category"]: r for r in marts.mart_spending_stats(ledger_of(spark, rows)).collect()}
    g = stats["Groceries"]
    assert g["median_monthly_spend"] == 6.0 and g["mean_monthly_spend"] == 6.0
    assert g["spend_range"] == 10.0 and g["total_transactions"] == 4
    s = stats["Subscriptions"]
    assert s["stddev_monthly_spend"] is None and s["median_monthly_spend"] == 7.0


def test_sunday_is_zero(spark):
    led = ledger_of(spark, [("s", "2024-01-07", "X", -1.0, "debit"), ("m", "2024-01-08", "X", -1.0, "debit")])
    got = {r["transaction_id"]: r["day_of_week"] for r in led.collect()}
    assert got == {"s": 0, "m": 1}


def test_duplicates_count_after_first_with_missing_ids(spark):
    df = spark.createDataFrame([(None, "2024-01-01", "A", "1", "debit"), (None, "2024-01-01", "A", "1", "debit"),
                                ("x", "2024-01-01", "A", "1", "debit"), ("x", "2024-01-01", "A", "1", "debit"),
                                ("x", "2024-01-01", "A", "1", "debit"), ("y", "2024-01-01", "A", "1", "debit")],
                               ",".join(f"{c} string" for c in BANK.required))
    assert quality.duplicate_ids(df, BANK).first()["n_bad"] == 3  # 1 (missing) + 2 (x)
    gate = quality.load_gate(standardise(df.withColumn("source", F.lit("bank"))), "bank").first()
    assert gate["duplicate_ids"] == 3 and not gate["passed"]


def test_early_exits(spark, tmp_path):
    df = spark.createDataFrame([("1", "2024-01-01", "A", "1")],
                               "transaction_id string, date string, description string, amount string")
    res = quality.profile(spark, df, BANK).collect()
    assert [r["check"] for r in res] == ["required_columns"] and res[0]["column"] == "transaction_type"
    empty = tmp_path / "empty.csv"
    empty.write_text("")
    header = tmp_path / "header.csv"
    header.write_text("transaction_id,date,description,amount,transaction_type\n")
    ready = {r["source"]: r["status"] for r in file_readiness(
        spark, {"a": str(tmp_path / "absent.csv"), "e": str(empty), "h": str(header)}).collect()}
    assert ready == {"a": "missing", "e": "empty", "h": "ready"}
    rows = quality.profile(spark, read_csv_text(spark, str(header)), BANK).collect()
    mins = [r for r in rows if r["check"] == "row_count_min"]
    assert mins[0]["n_bad"] == 1
    assert quality.unknown_source(spark, "cash").first()["severity"] == "error"


def test_unknown_type_fails_profile_but_passes_gate(spark):
    df = spark.createDataFrame([("1", "2024-01-01", "A", "1", "pending"), ("2", "2024-01-01", "A", "1", None)],
                               ",".join(f"{c} string" for c in BANK.required))
    res = {r["check"]: r for r in quality.profile(spark, df, BANK).collect()}
    t = res["invalid_transaction_types"]
    assert t["n_bad"] == 2 and t["sample"] == ["nan", "pending"]
    gate = quality.load_gate(standardise(df.withColumn("source", F.lit("bank"))), "bank").first()
    assert gate["passed"]


def test_changed_row_with_stored_id_is_ignored(spark, scratch):
    store = RawStore(spark, scratch("raw"))
    first = raw_frame(spark, [("a", "2024-01-01", "OLD", -1.0, "debit")], "bank")
    second = raw_frame(spark, [("a", "2024-01-01", "NEW", -9.0, "debit"),
                               ("b", "2024-01-02", "NEW", -2.0, "debit")], "bank")
    assert store.load(first, "t").rows_loaded == 1
    assert store.load(second, "t").rows_loaded == 1
    got = {r["transaction_id"]: r["description"] for r in store.read("t").collect()}
    assert got == {"a": "OLD", "b": "NEW"}


def test_per_source_outcome(spark, scratch, sample_paths, tmp_path):
    bad = tmp_path / "bad.csv"
    bad.write_text("transaction_id,post_date,merchant_name,amount,transaction_type\n"
                   "1,2024-01-01,A,n/a,debit\n")
    files = [SourceFile("bank", sample_paths["bank"]), SourceFile("card", str(bad)),
             SourceFile("cash", sample_paths["bank"])]
    out, ok = load_sources(spark, RawStore(spark, scratch("raw")), files)
    got = {r["source"]: (r["status"], r["rows_loaded"]) for r in out.collect()}
    assert not ok and got == {"bank": ("loaded", 20), "card": ("failed", 0), "cash": ("failed", 0)}
    out, ok = load_sources(spark, RawStore(spark, scratch("raw")),
                           [SourceFile("bank", str(tmp_path / "nowhere.csv"))])
    assert not ok and out.first()["status"] == "missing"


def test_stream_load_is_incremental(spark, scratch, sample_paths):
    store = RawStore(spark, scratch("raw"))
    landing, ckpt = scratch("landing"), scratch("ckpt")
    text = read_csv_text(spark, sample_paths["bank"]).drop("_malformed")
    write_csv(text.filter("transaction_id < 'TXN-011'"), landing + "/batch-1")
    first = stream_load(spark, store, BANK, landing + "/*", ckpt)
    assert sum(o["rows_loaded"] for o in first) == 10
    write_csv(text, landing + "/batch-2")  # overlaps batch 1: only 10 ids are new
    second = stream_load(spark, store, BANK, landing + "/*", ckpt)
    assert sum(o["rows_loaded"] for o in second) == 10
    assert store.read(BANK.raw_table).count() == 20
    assert stream_load(spark, store, BANK, landing + "/*", ckpt) == []  # nothing unseen


def test_mart_column_tests(spark):
    stats = marts.mart_spending_stats(ledger_of(spark, [("a", "2024-01-05", "KROGER", -1.0, "debit")]))
    nn = {r["column"]: r["passed"] for r in quality.test_not_null(stats, "m", ["category", "mean_monthly_spend"]).collect()}
    assert nn == {"category": True, "mean_monthly_spend": True}
    assert quality.test_unique(stats, "m", "category").first()["passed"]


def test_whitespace_and_null_tokens(spark, tmp_path):
    p = tmp_path / "ws.csv"
    p.write_text("transaction_id,post_date,merchant_name,amount,transaction_type\n"
                 " 007 ,01/05/2024,\tuber eats  ,NA, Credit\n")
    df = read_csv_text(spark, str(p))
    r = df.first()
    assert r["transaction_id"] == " 007 " and r["amount"] is None
    from tally.sources.files import map_to_common
    s = standardise(map_to_common(df, CARD)).first()
    assert s["transaction_id"] == "007" and s["description"] == "UBER EATS"
    assert s["transaction_type"] == "credit" and s["date"] == dt.datetime(2024, 1, 5)


def test_income_category_debit_month_is_absent(spark):
    """A debit in the Income category is neither spend nor income: its month
    appears in neither mart, so not in the savings mart either."""
    s = savings(spark, [("a", "2024-01-05", "PAYROLL CORRECTION", -10.0, "debit"),
                        ("b", "2024-02-05", "KROGER", -5.0, "debit")])
    assert list(s) == [dt.date(2024, 2, 1)]
