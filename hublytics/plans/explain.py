"""Physical-plan summaries: shuffles, broadcasts, join strategies, pushdown.

``plan_summary(df)`` reads ``df.explain("formatted")`` text (the public
API) and counts the operators that matter at scale, so a plan regression
(a new shuffle, a lost broadcast, a filter no longer pushed) shows up in
review. ``python -m hublytics.plans.explain`` writes PLANS.md for every
registered query.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

from pyspark.sql import DataFrame

COUNTED = {
    "shuffles": r"^\(\d+\) Exchange\b",
    "broadcasts": r"^\(\d+\) BroadcastExchange\b",
    "broadcast_hash_joins": r"^\(\d+\) BroadcastHashJoin\b",
    "sort_merge_joins": r"^\(\d+\) SortMergeJoin\b",
    "shuffled_hash_joins": r"^\(\d+\) ShuffledHashJoin\b",
    "nested_loop_joins": r"^\(\d+\) BroadcastNestedLoopJoin\b",
    "partial_group_limits": r"^Arguments: .*, Partial$",
    "hash_aggregates": r"^\(\d+\) (HashAggregate|ObjectHashAggregate|SortAggregate)\b",
    "windows": r"^\(\d+\) Window\b",
    "scans": r"^\(\d+\) Scan parquet",
    "pushed_filter_scans": r"^PushedFilters: \[.+\]",
    "python_udfs": r"(BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas)",
}


def formatted_plan(df: DataFrame) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def plan_summary(df: DataFrame) -> dict[str, int]:
    # a fresh (not yet executed) query: an executed adaptive plan prints
    # both its final and its initial tree, which would count nodes twice
    text = formatted_plan(df.select("*"))
    lines = text.splitlines()
    return {k: sum(1 for ln in lines if re.search(p, ln)) for k, p in COUNTED.items()}


def main(argv: list[str]) -> int:
    from hublytics import get_session
    from hublytics.plans.catalog import QUERIES
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    out = argv[1] if len(argv) > 1 else "PLANS.md"
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    rows = []
    for name, fn in QUERIES.items():
        s = plan_summary(fn(spark, sf_dir))
        rows.append((name, s))
    keys = list(COUNTED)
    with open(out, "w") as f:
        f.write("# Physical plans of the registered queries\n\n")
        f.write(f"Counts from `explain('formatted')` on `{sf_dir}` (fixture tables already written, so "
                "plans start at parquet scans). These are the initial (pre-execution) plans: shuffles = "
                "`Exchange` nodes; at run time AQE may coalesce them, turn a sort-merge join into a "
                "broadcast, and reuse identical exchanges (e.g. the one warehouse broadcast serving both "
                "trip ends of `fct_transportation` shows as `ReusedExchange` in the final plan).\n\n")
        f.write("| query | " + " | ".join(keys) + " |\n|---|" + "---|" * len(keys) + "\n")
        for name, s in rows:
            f.write(f"| {name} | " + " | ".join(str(s[k]) for k in keys) + " |\n")
    print(f"wrote {out} ({len(rows)} queries)")
    return 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
