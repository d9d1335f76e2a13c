"""Print the physical-plan shape of every registered query.

python plan_report.py [sf_dir]: scans, exchanges (single-partition ones
apart), broadcasts, sort-merge joins, nested-loop/Cartesian joins, windows.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallybook.plans.catalog import QUERIES  # noqa: E402
from tallybook.session import get_session  # noqa: E402

PATTERNS = {
    "scans": r"FileScan parquet",
    "exchanges": r"Exchange (?:hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)",
    "single": r"Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "nested_loop": r"BroadcastNestedLoopJoin|CartesianProduct",
    "windows": r"\bWindow\b",
}


def shape(df) -> dict[str, int]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    # an executed adaptive plan prints its final and its initial plan: count one
    plan = plan.split("== Initial Plan ==")[-1]
    return {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session("local[8]", shuffle_partitions=8)
    for name, fn in QUERIES.items():
        s = shape(fn(spark, sf_dir))
        print(f"{name:28s} " + " ".join(f"{k}={v}" for k, v in s.items()))


if __name__ == "__main__":
    main()
