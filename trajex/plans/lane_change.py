"""The lane-change extraction as one Spark job.

Intervals join ego (a broadcast range join), each (recording, interval)
group is scanned (W1, chunked), windows are built (W2) and checked against
the lane lines at the first ego time of the window (J5).  Recordings
without ego or line data simply produce no rows (J10)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajex.operators import filters as flt
from trajex.operators import geometry as geom
from trajex.operators import sequence as seq
from trajex.schema import EGO_PAD_SECONDS, SCAN_PIPELINE_A, SCAN_PIPELINE_B, ScanParams
from trajex.session import materialize

GROUP = ["recording_id", "id"]


def lane_change_pipeline(track: DataFrame, intervals: DataFrame, lines: DataFrame, *,
                         params: ScanParams = ScanParams.of(SCAN_PIPELINE_A), pad: float = 0.0,
                         group: list[str] = GROUP) -> DataFrame:
    """Validated lane-change windows, one row per (window, matching line).
    ``intervals`` has recording_id, id, start_time, end_time.  ``pad`` widens
    the ego slice only (version B pads by 10 s); lines stay inside the
    unpadded interval."""
    ego_iv = flt.interval_pad(intervals, pad) if pad else intervals
    keep = tuple(c for c in group if c != "recording_id")
    # the scan and the validation read the rows inside the intervals: join once
    inside = flt.within_intervals(track, ego_iv, keep=keep)
    ego = materialize(inside.select(*group, "ptp_time", "Yaw", "PositionX", "PositionY"), "ego_in_intervals")
    windows = seq.lane_change_windows(seq.yaw_return_scan(ego, group, params))
    return geom.lane_change_validate(windows, ego, lines, group, line_intervals=intervals)


def lane_change_pipeline_padded(track: DataFrame, intervals: DataFrame, lines: DataFrame,
                                **kw) -> DataFrame:
    """Version B: thresholds (40, 80, 0.013, 0.2), ego padded by 10 s."""
    return lane_change_pipeline(track, intervals, lines, params=ScanParams.of(SCAN_PIPELINE_B),
                                pad=EGO_PAD_SECONDS, **kw)


def lane_change_export(validated: DataFrame, group: list[str] = GROUP) -> DataFrame:
    """One row per (recording, interval) with the accepted windows as
    text ``[(start, end), ...]`` in time order, repeats kept."""
    agg = validated.groupBy(*group).agg(
        F.array_sort(F.collect_list(F.struct("lc_start", "lc_end"))).alias("_w"))
    text = F.concat(F.lit("["), F.array_join(F.transform("_w", lambda w: F.concat(
        F.lit("("), w["lc_start"].cast("string"), F.lit(", "), w["lc_end"].cast("string"), F.lit(")"))),
        ", "), F.lit("]"))
    return agg.select(*group, F.size("_w").alias("n_windows"), text.alias("lc"))


def write_lane_changes(exported: DataFrame, path: str) -> None:
    """S7 sink: CSV with a header, columns recording_id, lc."""
    exported.select("recording_id", "lc").write.mode("overwrite").option("header", True).csv(path)
