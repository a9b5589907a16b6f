"""End-to-end use of the library on the test tables.

    python examples/run_pipelines.py [/root/testdata/sf0.01] [out-folder]

Builds the telemetry fixtures, runs the scenario labelling (L5) and the
lane-change extraction (L6), and writes: labelled objects (parquet,
partitioned by recording), the lane-change list (CSV, S7) and the label
counts.  The output folder defaults to a fresh folder under the session's
checkpoint folder.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trajex.operators import labels as lab  # noqa: E402
from trajex.operators import tables as tb  # noqa: E402
from trajex.plans import lane_change as lcp  # noqa: E402
from trajex.plans.scenario import SceneInputs, scenario_labels  # noqa: E402
from trajex.session import local_session  # noqa: E402
from trajex.sources import fixtures as fx  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    out = sys.argv[2] if len(sys.argv) > 2 else tb.scratch_path(spark, "example")

    labels = scenario_labels(SceneInputs(fx.ego(spark, sf), fx.objects(spark, sf),
                                         fx.status(spark, sf), fx.intervals(spark, sf)))
    labels.write.mode("overwrite").partitionBy("recording_id").parquet(f"{out}/labels")
    counts = lab.label_counts(spark.read.parquet(f"{out}/labels")).orderBy("status")

    validated = lcp.lane_change_pipeline(fx.track(spark, sf), fx.track_intervals(spark, sf),
                                         fx.lane_lines(spark, sf))
    lcp.write_lane_changes(lcp.lane_change_export(validated), f"{out}/lane_changes")

    print(f"output under {out}")
    for r in counts.collect():
        print(f"status {r.status}: {r['count']} rows")
    print(f"lane-change files: {len(os.listdir(out + '/lane_changes'))}")


if __name__ == "__main__":
    main()
