"""Write the formatted physical plans of the headline queries to docs/plans/.

Usage: python scripts/explain_plans.py [sf_dir]
Each file is ``df.explain("formatted")`` after one execution (so the
adaptive plan is final), preceded by a short count of scans, exchanges and
join kinds.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

KEYS = ["mart_savings_rate", "mart_monthly_spend", "mart_income", "mart_spending_stats",
        "int_categorized", "spend_rows", "dq_report", "load_incremental"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from tally.queries import QUERIES
    from tally.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8)
    out_dir = os.path.join(ROOT, "docs", "plans")
    os.makedirs(out_dir, exist_ok=True)
    for key in KEYS:
        df = QUERIES[key](spark, sf)
        df.write.format("noop").mode("overwrite").save()
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain("formatted")
        text = buf.getvalue()
        tree = text.split("\n\n\n")[0]
        counts = {k: len(re.findall(pat, tree)) for k, pat in {
            "scans": r"Scan (parquet|csv)", "exchanges": r"Exchange", "windows": r"\bWindow\b",
            "broadcast_hash_joins": r"BroadcastHashJoin", "sort_merge_joins": r"SortMergeJoin",
            "in_memory_scans": r"InMemoryTableScan"}.items()}
        pushed = sorted(set(re.findall(r"PushedFilters: \[([^\]]*)\]", text)))
        header = (f"# {key} at {os.path.basename(sf)}\n# {counts}\n"
                  + "".join(f"# PushedFilters: [{p}]\n" for p in pushed) + "\n")
        with open(os.path.join(out_dir, f"{key}.txt"), "w") as f:
            f.write(header + text)
        print(key, counts, len(text))


if __name__ == "__main__":
    main()
