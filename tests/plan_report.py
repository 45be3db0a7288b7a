"""Summarise the final (adaptive) physical plan of every registered query.

python tests/plan_report.py [sf_dir] > PLANS.md   (queries of the library; those of strata.llm store their steps and show only the last)
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session  # noqa: E402


def summarise(plan: str) -> dict:
    final = plan.split("\n+- == Initial Plan ==")[0]
    lines = final.split("\n")
    joins = re.findall(r"(BroadcastHashJoin|SortMergeJoin(?:\(skew=true\))?|ShuffledHashJoin|BroadcastNestedLoopJoin|CartesianProduct)[^\n]*?(Inner|LeftOuter|RightOuter|FullOuter|LeftSemi|LeftAnti|Cross)", final)
    scans = re.findall(r"FileScan parquet \[([^\]]*)\][^\n]*?Location: \w+\(\d+ paths\)\[file:[^\]]*/([\w.]+)\]", final)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", final)
    partitions = re.findall(r"PartitionFilters: \[([^\]]*)\]", final)
    notes = []
    for key, label in (
        ("WindowGroupLimit", "partial group limit before shuffle"),
        ("TakeOrderedAndProject", "top-n without full sort"),
        ("ReusedExchange", "exchange reused"),
        ("ReusedSubquery", "subquery reused"),
        ("Expand", "rollup/distinct expand"),
        ("AQEShuffleRead coalesced", "AQE coalesced"),
        ("AQEShuffleRead local", "AQE local read"),
        ("ArrowEvalPython", "PYTHON UDF"),
        ("BatchEvalPython", "PYTHON UDF"),
    ):
        if key in final and label not in notes:
            notes.append(label)
    return {
        "exchanges": sum(1 for ln in lines if re.search(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", ln)),
        "broadcasts": sum(1 for ln in lines if "BroadcastExchange" in ln),
        "joins": ", ".join(f"{j[0]} {j[1]}" for j in joins) or "-",
        "scans": "; ".join(f"{t.replace('.parquet', '')}({len(c.split(','))} cols)" for c, t in scans) or "-",
        "pushed": sum(1 for p in pushed if p.strip()),
        "partition_filters": sum(1 for p in partitions if p.strip()),
        "notes": ", ".join(notes) or "-",
    }


def main() -> None:
    from strata.plans.catalog import QUERIES

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(master="local[8]", shuffle_partitions=8, conf={"spark.driver.memory": "8g"})
    print("# Physical plans of the registered queries\n")
    print(f"Final adaptive plans after execution at `{sf_dir}` on `local[8]` (generated by `tests/plan_report.py`).")
    print("Exchanges = shuffles (hash, range or single-partition) in the final plan; broadcasts = broadcast")
    print("exchanges chosen by the planner's size check or by AQE at run time; scans list the columns read per")
    print("table (column pruning); pushed = scans with filters pushed into Parquet.\n")
    print("| query | exchanges | broadcasts | joins | scans (columns read) | pushed | notes |")
    print("|---|---|---|---|---|---|---|")
    for name, fn in sorted(QUERIES.items()):
        df = fn(spark, sf_dir)
        df.collect()
        s = summarise(df._jdf.queryExecution().executedPlan().toString())
        print(
            f"| {name} | {s['exchanges']} | {s['broadcasts']} | {s['joins']} | {s['scans']} | "
            f"{s['pushed']} | {s['notes']} |",
            flush=True,
        )
    spark.stop()


if __name__ == "__main__":
    main()
