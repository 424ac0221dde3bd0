"""Print the physical plans of the headline queries (for PLANS.md).

Usage: python tools/plans.py [sf_dir] > PLANS.md
Shows each plan's operator tree with the scan's ReadSchema and pushed
filters, and counts the exchanges (shuffles) and broadcasts.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from modelyard.registry import QUERIES, load_all  # noqa: E402
from modelyard.session import local_session  # noqa: E402

NAMES = ["regression_leaderboard", "lineitem_leaderboard", "lineitem_cv_metrics", "hash_split_rows",
         "session_sql", "filter_stage", "roc_points", "registry_versions", "nearest_class_mean",
         "last_active_run", "grouped_least_squares"]


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8, 8)
    load_all()
    print("# Physical plans of the headline queries\n")
    print(f"Generated by `tools/plans.py` on `{sf_dir}` (local[8]); the final plan of each")
    print("registered query as Spark prints it before execution (AQE may still coalesce")
    print("partitions or switch join strategy at run time). Scan lines keep only the")
    print("read schema and pushed filters.\n")
    for name in NAMES:
        df = QUERIES[name](spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        lines = []
        for ln in plan.splitlines():
            ln = re.sub(r"#\d+L?", "", ln)
            if "FileScan" in ln or "Scan parquet" in ln:
                ln = ln.split("[")[0] + "(details below)"
            lines.append(ln[:200])
        formatted = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        scans = [re.sub(r"#\d+L?", "", x).strip() for x in formatted.splitlines()
                 if x.startswith(("Location:", "PushedFilters:", "ReadSchema:"))]
        ex = sum(1 for ln in lines if "Exchange" in ln and "Broadcast" not in ln)
        bc = sum(1 for ln in lines if "BroadcastExchange" in ln)
        print(f"## {name}\n")
        print(f"{(QUERIES[name].__doc__ or '').strip().splitlines()[0] if QUERIES[name].__doc__ else ''}\n")
        print(f"Shuffle exchanges in the final plan: {ex}; broadcasts: {bc}.\n")
        print("```")
        print("\n".join(lines))
        print("```\n")
        if scans:
            print("Scans:\n")
            print("```")
            print("\n".join(x[:200] for x in scans))
            print("```\n")


if __name__ == "__main__":
    main()
