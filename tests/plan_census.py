"""Count operators in the final (adaptive) physical plan of every registered analytic.

Usage: python tests/plan_census.py [sf_dir] > PLANS.md
Each query is executed once (noop sink) so ``explain`` shows the final plan.
"""

from __future__ import annotations

import contextlib
import io
import re
import sys

sys.path.insert(0, ".")

PATTERNS = {
    "input scans": None,   # scans of the given tables
    "stored inputs": None,  # checkpoints and tables written by earlier steps
    "shuffles": r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition|\bExchange RoundRobin",
    "reused": r"ReusedExchange|ReusedSubquery",
    "broadcasts": r"BroadcastExchange",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast joins": r"BroadcastHashJoin|BroadcastNestedLoopJoin",
    "windows": r"^\s*[+:\- ]*Window \[|^\s*[+:\- ]*WindowGroupLimit",
    "python": r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas",
}


def census(df, sf_dir: str) -> dict[str, int]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    out = {k: len(re.findall(p, text, flags=re.M)) for k, p in PATTERNS.items() if p}
    scans = [ln for ln in text.splitlines() if "FileScan parquet" in ln]
    given = sum(1 for ln in scans if sf_dir.rstrip("/") in ln)
    out["input scans"] = given
    out["stored inputs"] = len(scans) - given + text.count("Scan ExistingRDD")
    return out


if __name__ == "__main__":
    import __spark_entry__ as E
    from assetflow.session import build_session

    import os

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    at_scale = os.environ.get("CENSUS_AT_SCALE") == "1"
    extra = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"} if at_scale else {}
    spark = build_session("local[4]", shuffle_partitions=8, extra=extra)
    if at_scale:
        print(f"## At-scale shape ({sf_dir}, size-based automatic broadcasts off)\n")
        print("With the planner's own broadcast thresholds disabled, as they would not fire on "
              "large inputs, only the size-checked broadcasts of dimension-sized tables remain.\n")
    else:
        print(f"# Plan census ({sf_dir}, final adaptive plans)\n")
    if not at_scale:
        print("Operators in the physical plan that produces each registered analytic (the last job; "
              "eager steps such as stream runs, loads and checkpoints run before it). Generated by "
              "`python tests/plan_census.py`.\n")
    print("| query | " + " | ".join(PATTERNS) + " |")
    print("|---|" + "---|" * len(PATTERNS))
    for name, fn in E.queries().items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        c = census(df, sf_dir)
        print(f"| `{name}` | " + " | ".join(str(c[k]) for k in PATTERNS) + " |", flush=True)
