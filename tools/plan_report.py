"""Summarise the physical plan of every registered query (PLANS.md).

Runs each query (collecting its small result, so the DataFrame's own adaptive
plan is the one executed) and counts operators in the *final* adaptive plan,
where repeated subtrees show up as reused exchanges.
Usage: python tools/plan_report.py [sf_dir] > PLANS.md
"""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PATTERNS = {
    "scans": r"FileScan parquet|Scan parquet",
    "exchanges": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin",
    "broadcasts": r"BroadcastExchange",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "windows": r"\bWindow \[",
    "aggregates": r"HashAggregate|ObjectHashAggregate|SortAggregate",
    "reused": r"ReusedExchange",
    "python": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
    "cartesian": r"CartesianProduct|BroadcastNestedLoopJoin",
}


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import SparkSession
    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.shuffle.partitions", "8")
             .config("spark.sql.session.timeZone", "UTC").config("spark.sql.maxMetadataStringLength", "1000").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from wattgrid.plans import registry
    print("# Physical plans of the registered queries\n")
    print(f"Final adaptive plans at `{sf}` (local[8], 8 shuffle partitions), generated by "
          "`tools/plan_report.py`. `exchanges` counts shuffle exchanges (including reused ones), "
          "`reused` the exchanges served from an identical subtree computed once, `bhj`/`smj` "
          "broadcast-hash / sort-merge joins; `pushed` lists non-null filters that reached a Parquet "
          "scan. Streaming queries are omitted.\n")
    cols = list(PATTERNS) + ["pushed"]
    print("| query | " + " | ".join(cols) + " |")
    print("|---" * (len(cols) + 1) + "|")
    for name, fn in registry.queries().items():
        if name.startswith("stream_"):
            print(f"| {name} | " + " | ".join(["-"] * len(cols)) + " |")
            continue
        df = fn(spark, sf)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        counts = [str(len(re.findall(p, plan))) for p in PATTERNS.values()]
        pushed = sorted({f for m in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) for f in m.split(", ") if f
                         and not f.startswith("IsNotNull")})
        print(f"| {name} | " + " | ".join(counts) + f" | {'; '.join(pushed)[:160]} |")


if __name__ == "__main__":
    main()
