"""Benchmark the headline queries.

Runs each query on the tables in $BENCH_SF_DIR (default /root/testdata/sf0.1)
on local[$BENCH_CPUS], executing the full plan into Spark's ``noop`` sink
(nothing is collected to the driver).  One warm-up pass over all queries,
then $BENCH_RUNS interleaved passes; the median per query.  Prints one JSON
line.

Pairs ``*_naive`` / rewritten compare the plan as first written against the
rewritten plan: the overlay (``scenario_labels``), the scene summary
(``scene_summary_eager``) and the yaw scan (``lane_change_scan``, whose naive
form hands each whole group to one Python call).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def naive_queries():
    from trajex.operators import labels as lab
    from trajex.operators import sequence as seq
    from trajex.plans import queries as qm
    from trajex.plans import scenario as scn
    from trajex.schema import SCAN_BASIC, ScanParams

    def scenario_labels_naive(spark, sf):
        return scn.scenario_labels_naive(qm.scene_inputs(spark, sf))

    def scene_summary_naive(spark, sf):
        ego, obj = qm._ego_obj(spark, sf)
        return lab.scene_summary_naive(obj, ego)

    def scene_summary_eager(spark, sf):
        ego, obj = qm._ego_obj(spark, sf)
        return lab.scene_summary(obj, ego)

    def lane_change_scan_naive(spark, sf):
        """The scan with one Python call per (recording, interval) group, each
        group whole in one task (comparison only; not a library path): the
        library's search and walk without its numbering, chunks and batches."""
        import numpy as np
        import pandas as pd

        p = ScanParams.of(SCAN_BASIC)

        def per_group(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("ptp_time", ignore_index=True)
            rows = np.arange(len(pdf))
            k = seq.first_hits(np.append(pdf["Yaw"], np.full(p.maximum, np.nan)), rows, rows % 2 == 1, p)
            hit = np.flatnonzero(k)
            step, emit = seq._steps(k[hit], p)
            i = np.array([hit[n] for n in seq._walk(hit, step, 0, len(pdf)) if emit[n]], dtype=np.int64)
            t = pdf["ptp_time"].to_numpy()
            return pdf.loc[i, ["recording_id", "id"]].assign(i=i, j=i + k[i], t_i=t[i], t_j=t[i + k[i]])

        tr = qm.track_in_intervals(spark, sf).select("recording_id", "id", "ptp_time", "Yaw")
        return tr.groupBy("recording_id", "id").applyInPandas(
            per_group, "recording_id string, id int, i long, j long, t_i double, t_j double")

    return {"scenario_labels_naive": scenario_labels_naive,
            "scene_summary_naive": scene_summary_naive,
            "scene_summary_eager": scene_summary_eager,
            "lane_change_scan_naive": lane_change_scan_naive}


HEADLINE = [
    "scenario_labels", "scenario_labels_naive", "scene_summary_eager", "scene_summary_naive",
    "speed_attach", "lane_change_scan", "lane_change_scan_naive", "lane_change_pipeline", "lane_change_pipeline_padded",
    "trajectory_pipeline", "position_stitch", "boundary_cross_any", "straight_scene",
    "signal_density", "tag_overlap", "annotation_parse", "key_lookup",
]


def main() -> None:
    from trajex.plans.queries import Q
    from trajex.session import local_session
    # BENCH_EVENT_LOG=<folder>: keep Spark's event log for stage/task times
    spark = local_session(CPUS, event_log_dir=os.environ.get("BENCH_EVENT_LOG"))
    qs = dict(Q)
    qs.update(naive_queries())
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    runs: dict[str, list[float]] = {n: [] for n in names}
    failed = {}
    # one warm-up pass, then interleaved timed passes: every pass runs each
    # query once, so JIT warm-up and machine noise spread over all queries
    for k in range(RUNS + 1):
        for name in names:
            if name in failed:
                continue
            try:
                t0 = time.perf_counter()
                # building the query is timed too: some operators write an
                # intermediate table or run a size check when called
                qs[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
                if k:
                    runs[name].append(time.perf_counter() - t0)
            except Exception as e:  # noqa: BLE001 - report and go on
                failed[name] = str(e)[:200]
    timings = {n: round(statistics.median(r), 3) for n, r in runs.items() if r and n not in failed}
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    out = {"metric": "sum_median_query_sec", "value": round(sum(timings.values()), 3),
           "unit": "sec", "queries": timings, "sf": sf, "cpus": CPUS, "runs": RUNS}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))


if __name__ == "__main__":
    main()
