"""Write the physical plans of the headline queries to docs/PLANS.md.

Usage: python tools/explain_plans.py [sf_dir]

For each query: the operator tree of ``explain("formatted")`` and the columns
each Parquet scan reads, so the plan shape (partial limits and aggregates before
exchanges, top-k, pruned scans) can be reviewed without running Spark.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from reelhouse import registry  # noqa: E402
from reelhouse.session import local_session  # noqa: E402

QUERIES = [
    "silver_ratings", "silver_diary", "gold_top_rated_movies", "gold_best_movie_year",
    "gold_watch_activity", "fingerprint", "latest_object", "insert_if_absent", "check_suite",
    "silver_diary_incremental",
]


def plan_summary(df) -> str:
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    tree = text.split("\n\n\n")[0]
    scans = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*>)", text)))
    pushed = sorted(set(re.findall(r"PushedFilters: (\[[^\n]*\])", text)))
    out = [tree.strip(), ""]
    out += [f"ReadSchema: {s}" for s in scans]
    out += [f"PushedFilters: {p}" for p in pushed if p != "[]"]
    return "\n".join(out)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    parts = [
        "# Physical plans of the headline queries",
        "",
        f"Generated by `tools/explain_plans.py` on `{sf_dir}` (Spark {spark.version}, "
        "AQE on; the initial plan, before AQE re-plans at run time).",
        "",
    ]
    for name in QUERIES:
        df = registry.QUERIES[name](spark, sf_dir)
        parts += [f"## {name}", "", "```", plan_summary(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "docs", "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(parts))
    print(path)


if __name__ == "__main__":
    main(sys.argv)
