"""Batch job: validate, load, build and test the marts.

    python -m tally.plans.job --bank PATH --card PATH --store ROOT --marts ROOT
                              [--start-date 2024-01-01] [--full-refresh]

(on a cluster: spark-submit --py-files tally.zip tally/plans/job.py ...)

With --carry-provider-category the card export's merchant_category is stored
in the raw card table and takes precedence over the rules.

Steps: validation report (written next to the marts), per-source gated
incremental load into the raw tables, the four marts written as snapshots
(full rebuild; read them with ``SnapshotStore(spark, marts).read(name)``), then
the mart column tests. Exit status 1 when a
source failed to load or a column test failed, as the reference's scripts
signal failure.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tally.operators import quality
from tally.plans.models import ModelOptions, build_marts
from tally.schema import BANK, CARD, PROVIDER_COLUMN
from tally.sources.loader import SourceFile, load_sources
from tally.sources.raw import RawStore
from tally.sources.snapshots import SnapshotStore

#: Snapshots of each mart that a run leaves: the new one, and the one that readers may still be at.
KEPT = 2


def run(spark: SparkSession, bank: str, card: str, store_root: str, marts_root: str,
        start_date: str = "2024-01-01", full_refresh: bool = False,
        carry_provider_category: bool = False) -> dict:
    tables = SnapshotStore(spark, marts_root)
    results, _ = quality.validation_report(spark, {"bank": bank, "card": card})
    tables.write(results, "validation_checks")  # the exports are validated once, here
    tables.write(quality.summarise(tables.read("validation_checks")), "validation_summary")
    summary = tables.read("validation_summary")

    carried = {CARD.raw_table: tuple(PROVIDER_COLUMN.values())} if carry_provider_category else {}
    store = RawStore(spark, store_root, carry=carried)
    outcome, all_loaded = load_sources(spark, store, [SourceFile("bank", bank), SourceFile("card", card)],
                                       full_refresh=full_refresh,
                                       carry={"card": PROVIDER_COLUMN} if carry_provider_category else None)
    tables.write(outcome, "load_outcome")

    opts = ModelOptions(start_date=start_date, carry_provider_category=carry_provider_category)
    marts = build_marts(store.read(BANK.raw_table), store.read(CARD.raw_table), opts)
    try:
        for name, df in marts.items():
            if not name.startswith("_"):
                tables.write(df, name)
    finally:
        marts["_rollup"].unpersist()

    for name in ("validation_checks", "validation_summary", "load_outcome", *(n for n in marts if not n.startswith("_"))):
        tables.vacuum(name, keep=KEPT)

    stats = tables.read("mart_spending_stats")
    tests = quality.test_not_null(stats, "mart_spending_stats", ["category", "mean_monthly_spend"]) \
        .unionByName(quality.test_unique(stats, "mart_spending_stats", "category"))
    tests_passed = all(r["passed"] for r in tests.collect())
    return {"all_loaded": all_loaded, "tests_passed": tests_passed,
            "validation_passed": summary.filter("source = 'ALL'").first()["passed"]}


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--bank", required=True)
    ap.add_argument("--card", required=True)
    ap.add_argument("--store", required=True)
    ap.add_argument("--marts", required=True)
    ap.add_argument("--start-date", default="2024-01-01")
    ap.add_argument("--full-refresh", action="store_true")
    ap.add_argument("--carry-provider-category", action="store_true")
    ap.add_argument("--master", default=None, help="only when not submitted (e.g. local[*])")
    a = ap.parse_args(argv)
    from tally.session import build_session, clean_scratch
    spark = build_session(a.master)
    try:
        out = run(spark, a.bank, a.card, a.store, a.marts, a.start_date, a.full_refresh,
                  a.carry_provider_category)
    finally:
        clean_scratch(spark)
    print(out)
    return 0 if out["all_loaded"] and out["tests_passed"] else 1


if __name__ == "__main__":
    sys.exit(main())
