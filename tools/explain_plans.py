"""Summarise the physical plans of the headline queries into PLANS.md.

    python tools/explain_plans.py [--sf /root/testdata/sf0.01] [--out PLANS.md]

For each query: counts of shuffles, broadcasts, join kinds, windows and
Python stages in the formatted plan, and each scan's pushed filters and
read schema (column pruning).  Operators that write an intermediate table
show the plan of the part after it.
"""

from __future__ import annotations

import argparse
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

QUERIES = ["scenario_labels", "scenario_labels_store", "speed_attach", "scene_summary", "highway_filter", "lane_change_scan",
           "lane_change_pipeline", "trajectory_pipeline", "position_stitch", "boundary_cross_any",
           "straight_scene", "tag_overlap", "annotation_parse", "key_lookup", "replace_rows",
           "signal_density", "geo_centre", "interval_ends", "sketch_quantiles", "tag_ranked_page", "tag_json_flatten"]

COUNTED = [("shuffles", r"^\(\d+\) Exchange$"), ("broadcasts", r"^\(\d+\) BroadcastExchange$"),
           ("broadcast joins", r"^\(\d+\) BroadcastHashJoin"), ("sort-merge joins", r"^\(\d+\) SortMergeJoin"),
           ("windows", r"^\(\d+\) Window"), ("python stages", r"^\(\d+\) FlatMapGroupsInPandas"),
           ("scans", r"^\(\d+\) Scan ")]


def formatted(df) -> str:
    jvm = df.sparkSession._jvm
    return jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


def summarise(name: str, plan: str) -> str:
    lines = plan.splitlines()
    counts = {k: sum(1 for ln in lines if re.match(rx, ln.strip())) for k, rx in COUNTED}
    scans, cur = [], None
    for ln in lines:
        m = re.match(r"^\((\d+)\) Scan (\S+)", ln.strip())
        if m:
            cur = {"n": m.group(1)}
            scans.append(cur)
        elif cur is not None and ln.startswith("Location:"):
            cur["loc"] = ln.split("[")[-1].rstrip("]").split("/")[-1]
        elif cur is not None and ln.startswith("PushedFilters:"):
            cur["pushed"] = ln[len("PushedFilters:"):].strip()
        elif cur is not None and ln.startswith("ReadSchema:"):
            cur["schema"] = ln[len("ReadSchema:"):].strip()
            cur = None
    out = [f"### {name}", "", " | ".join(f"{k}: {v}" for k, v in counts.items()), ""]
    for s in scans:
        out.append(f"* scan `{s.get('loc', '?')}` pushed {s.get('pushed', '[]')}; reads `{s.get('schema', '')}`")
    return "\n".join(out) + "\n"


def main():
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("--out", default="PLANS.md")
    a = ap.parse_args()
    from trajex.plans.queries import Q
    from trajex.session import local_session
    spark = local_session(8)
    parts = ["# Physical plan summaries", "",
             f"Generated by `tools/explain_plans.py` on `{a.sf}` (local[8], AQE on; the",
             "plans shown are before AQE's runtime changes).", ""]
    for name in QUERIES:
        parts.append(summarise(name, formatted(Q[name](spark, a.sf))))
    with open(a.out, "w") as f:
        f.write("\n".join(parts))
    print(f"wrote {a.out}")


if __name__ == "__main__":
    main()
