"""Registered queries: one per operator of the inventory, each a function
``(spark, sf_dir) -> DataFrame`` over the fixtures derived from the test
tables.  Values that come out of floating arithmetic (means, R2, angles,
densities) are rounded to 6 places so they compare across engines."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajex.functions import geometry as geo
from trajex.operators import filters as flt
from trajex.operators import geometry as geom
from trajex.operators import labels as lab
from trajex.operators import metadata as md
from trajex.operators import sequence as seq
from trajex.operators import stats as sts
from trajex.operators import tables as tb
from trajex.operators import tags as tg
from trajex.plans import lane_change as lcp
from trajex.plans import scenario as scn
from trajex.schema import (SCAN_BASIC, SCAN_HEADING, SCAN_LONG, SCAN_PIPELINE_A, SCAN_PIPELINE_B,
                           STRAIGHT_R2_MIN_OLD, STRAIGHT_SHARE_MIN_OLD, ScanParams)
from trajex.session import table_path
from trajex.sources import fixtures as fx
from trajex.sources import intervals as ivs
from trajex.sources import recordings as rc

Q: dict = {}


def query(name):
    def deco(fn):
        Q[name] = fn
        return fn
    return deco


def r6(c: str):
    return F.round(F.col(c), 6).alias(c)


def scene_inputs(spark: SparkSession, sf: str) -> scn.SceneInputs:
    return scn.SceneInputs(fx.ego(spark, sf), fx.objects(spark, sf), fx.status(spark, sf),
                           fx.intervals(spark, sf))


# --- scene pipeline ---------------------------------------------------------------

@query("highway_filter")
def q_highway_filter(spark, sf) -> DataFrame:
    return flt.highway_filter(fx.ego(spark, sf), fx.intervals(spark, sf))


@query("time_grid")
def q_time_grid(spark, sf) -> DataFrame:
    return fx.objects(spark, sf).select(
        "recording_id", "TrackingID", "MessageNumber", "ptp_time",
        flt.time_grid("ptp_time").alias("ptp_time_grid"))


@query("ego_speed")
def q_ego_speed(spark, sf) -> DataFrame:
    e = flt.ego_speed(fx.ego(spark, sf))
    return e.select("recording_id", "ptp_time", "VelocityX", "VelocityY", r6("Velocity"))


@query("object_roi")
def q_object_roi(spark, sf) -> DataFrame:
    return flt.object_roi(fx.objects(spark, sf))


@query("object_dedup")
def q_object_dedup(spark, sf) -> DataFrame:
    inp = scene_inputs(spark, sf)
    return flt.filter_objects(flt.highway_filter(inp.objects, inp.intervals))


@query("status_projection")
def q_status_projection(spark, sf) -> DataFrame:
    return flt.status_projection(fx.status(spark, sf))


def _status_hw(spark, sf):
    inp = scene_inputs(spark, sf)
    return flt.highway_filter(flt.status_projection(inp.status), inp.intervals)


@query("label_lane_change")
def q_label_lane_change(spark, sf) -> DataFrame:
    return lab.label_lane_change(_status_hw(spark, sf))


@query("label_emergency_brake")
def q_label_emergency_brake(spark, sf) -> DataFrame:
    return lab.label_emergency_brake(_status_hw(spark, sf))


@query("label_turning")
def q_label_turning(spark, sf) -> DataFrame:
    return lab.label_turning(_status_hw(spark, sf))


def _ego_obj(spark, sf):
    inp = scene_inputs(spark, sf)
    ego = flt.ego_speed(flt.highway_filter(inp.ego, inp.intervals))
    obj = flt.filter_objects(flt.highway_filter(inp.objects, inp.intervals))
    return ego, obj


@query("scene_summary")
def q_scene_summary(spark, sf) -> DataFrame:
    ego, obj = _ego_obj(spark, sf)
    s = lab.scene_summary(obj, ego)
    return s.select("recording_id", "ptp_time", "count", r6("avg_v"), r6("ego_v"))


@query("label_congestion")
def q_label_congestion(spark, sf) -> DataFrame:
    ego, obj = _ego_obj(spark, sf)
    return lab.label_congestion(lab.scene_summary(obj, ego))


@query("ego_object_join")
def q_ego_object_join(spark, sf) -> DataFrame:
    ego, obj = _ego_obj(spark, sf)
    j = lab.ego_object_join(obj, ego)
    return j.withColumn("Velocity", F.round("Velocity", 6))


@query("scenario_overlay")
def q_scenario_overlay(spark, sf) -> DataFrame:
    """J3 on its own: the one-join overlay of the four label sets."""
    ego, obj = _ego_obj(spark, sf)
    st = _status_hw(spark, sf)
    return lab.combine_status(obj, lab.label_lane_change(st), lab.label_emergency_brake(st),
                              lab.label_turning(st),
                              lab.label_congestion(lab.scene_summary(obj, ego)))


@query("scenario_labels")
def q_scenario_labels(spark, sf) -> DataFrame:
    return scn.scenario_labels(scene_inputs(spark, sf))


@query("speed_attach")
def q_speed_attach(spark, sf) -> DataFrame:
    return scn.scenario_labels(scene_inputs(spark, sf), attach_speed=True)


@query("scenario_labels_store")
def q_scenario_labels_store(spark, sf) -> DataFrame:
    """L5 on objects stored in buckets: no object crosses the network."""
    inp = scene_inputs(spark, sf)
    name = f"objects_{uuid.uuid4().hex[:12]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scn.write_object_store(inp.objects, name, buckets, tb.scratch_path(spark, "object_store"))
    return scn.scenario_labels(scn.SceneInputs(inp.ego, scn.object_store(spark, name), inp.status, inp.intervals, stored=True))


@query("interval_ends")
def q_interval_ends(spark, sf) -> DataFrame:
    """F1/J1 with open, years long, reversed, NaN and null ends: the number of
    track rows in each interval and the first and last of them."""
    iv = fx.load(spark, sf, "odd_interval")
    return flt.interval_totals(fx.track(spark, sf), iv, keep=("id",))


@query("rows_per_vehicle")
def q_rows_per_vehicle(spark, sf) -> DataFrame:
    inp = scene_inputs(spark, sf)
    return lab.rows_per_vehicle(flt.highway_filter(inp.ego, inp.intervals))


@query("label_counts")
def q_label_counts(spark, sf) -> DataFrame:
    return lab.label_counts(scn.scenario_labels(scene_inputs(spark, sf)))


@query("labelled_total")
def q_labelled_total(spark, sf) -> DataFrame:
    return lab.labelled_total(scn.scenario_labels(scene_inputs(spark, sf)))


# --- sequence operators ----------------------------------------------------------------


TG = ["recording_id", "id"]


def track_in_intervals(spark, sf, pad: float = 0.0):
    iv = fx.track_intervals(spark, sf)
    if pad:
        iv = flt.interval_pad(iv, pad)
    return flt.within_intervals(fx.track(spark, sf), iv, keep=("id",))


def _pairs(df):
    return df.select(*TG, "i", "j", "t_i", "t_j")


@query("lane_change_scan")
def q_lane_change_scan(spark, sf) -> DataFrame:
    """W1 basic variant over every (recording, interval) group."""
    return _pairs(seq.yaw_return_scan(track_in_intervals(spark, sf), TG, ScanParams.of(SCAN_BASIC)))


@query("lane_change_windows")
def q_lane_change_windows(spark, sf) -> DataFrame:
    """W1 pipeline-A variant plus W2 windows."""
    p = seq.yaw_return_scan(track_in_intervals(spark, sf), TG, ScanParams.of(SCAN_PIPELINE_A))
    w = seq.lane_change_windows(p)
    return w.select(*TG, "i", "j", "t_i", "t_j", r6("lc_start"), r6("lc_end"))


@query("lane_change_scan_b")
def q_lane_change_scan_b(spark, sf) -> DataFrame:
    """W1 pipeline-B thresholds (40, 80, 0.013, 0.2) on the unpadded slice."""
    return _pairs(seq.yaw_return_scan(track_in_intervals(spark, sf), TG,
                                      ScanParams.of(SCAN_PIPELINE_B)))


@query("long_manoeuvre_scan")
def q_long_manoeuvre_scan(spark, sf) -> DataFrame:
    """100..150 rows, no upper amplitude."""
    return _pairs(seq.yaw_return_scan(track_in_intervals(spark, sf), TG, ScanParams.of(SCAN_LONG)))


@query("lane_change_refined")
def q_lane_change_refined(spark, sf) -> DataFrame:
    """Basic pairs not contained in a long-manoeuvre pair."""
    tr = track_in_intervals(spark, sf)
    short = _pairs(seq.yaw_return_scan(tr, TG, ScanParams.of(SCAN_BASIC)))
    long = _pairs(seq.yaw_return_scan(tr, TG, ScanParams.of(SCAN_LONG)))
    return seq.containment_anti(short, long, TG)


@query("containment_anti")
def q_containment_anti(spark, sf) -> DataFrame:
    """Pipeline-A windows not inside a long-manoeuvre pair."""
    tr = track_in_intervals(spark, sf)
    short = seq.lane_change_windows(seq.yaw_return_scan(tr, TG, ScanParams.of(SCAN_PIPELINE_A)))
    long = seq.yaw_return_scan(tr, TG, ScanParams.of(SCAN_LONG))
    out = seq.containment_anti(short, long, TG, start="lc_start", end="lc_end")
    return out.select(*TG, "i", "j", r6("lc_start"), r6("lc_end"))


@query("position_stitch")
def q_position_stitch(spark, sf) -> DataFrame:
    """W6 over each whole recording."""
    st = seq.position_stitch(fx.track(spark, sf), ["recording_id"])
    return st.select("recording_id", "ptp_time", "row_no", r6("PositionX"), r6("PositionY"),
                     r6("PositionZ"), F.col("_jump").alias("is_jump"))


@query("gap_stitch")
def q_gap_stitch(spark, sf) -> DataFrame:
    """W6 on a track with NaN and null positions: moves to and from them are no
    jumps.  Positions that are NaN or null come as null."""
    st = seq.position_stitch(fx.gap_track(spark, sf), ["recording_id"])
    return st.select("recording_id", "ptp_time", "row_no", F.col("_jump").alias("is_jump"), r6("PositionY"),
                     F.when(~F.isnan("PositionX"), F.round("PositionX", 6)).alias("PositionX"))


@query("heading")
def q_heading(spark, sf) -> DataFrame:
    """W7 over each whole recording."""
    h = seq.heading(fx.track(spark, sf), ["recording_id"])
    return h.select("recording_id", "ptp_time", "row_no", r6("angle"))


@query("trajectory_pipeline")
def q_trajectory_pipeline(spark, sf) -> DataFrame:
    """Per interval slice, stitch positions, add heading, scan yaw."""
    tr = track_in_intervals(spark, sf)
    proc = seq.trajectory_process(tr, TG)
    return _pairs(seq.yaw_return_scan(proc, TG, ScanParams.of(SCAN_BASIC)))


@query("heading_scan")
def q_heading_scan(spark, sf) -> DataFrame:
    """The return scan on the heading angle (45..80 rows, 0.01..0.02)."""
    tr = track_in_intervals(spark, sf)
    proc = seq.trajectory_process(tr, TG)
    return _pairs(seq.yaw_return_scan(proc, TG, ScanParams.of(SCAN_HEADING), value="angle"))


@query("polyline_merge")
def q_polyline_merge(spark, sf) -> DataFrame:
    """Merged lane lines per scene, summarised (point count, ends, sums)."""
    m = seq.polyline_merge(fx.polylines(spark, sf), ["recording_id", "ptp_time"])
    return m.select("recording_id", "ptp_time", "run_no", "TrackingID", "line_seq",
                    F.size("BoundaryLineX").alias("n_points"),
                    F.element_at("BoundaryLineX", -1).alias("x_last"),
                    F.round(F.aggregate("BoundaryLineY", F.lit(0.0), lambda a, v: a + v), 6).alias("y_sum"),
                    F.round(F.element_at("BoundaryLineY", -1), 6).alias("y_last"))


@query("pose_recentre")
def q_pose_recentre(spark, sf) -> DataFrame:
    """Positions relative to the pose at each recording's first time at
    or after 100 s."""
    tr = fx.track(spark, sf)
    ref = tr.where("ptp_time >= 100").groupBy("recording_id").agg(F.min("ptp_time").alias("ref_time"))
    out = seq.pose_recentre(tr, ref)
    return out.select("recording_id", "ptp_time", r6("AdjustedPositionX"), r6("AdjustedPositionY"))


# --- geometry ---------------------------------------------------------------------------


SCENE_KEY = ["recording_id", "ptp_time"]


@query("polyline_length")
def q_polyline_length(spark, sf) -> DataFrame:
    return fx.polylines(spark, sf).select(*SCENE_KEY, "line_seq",
                                          F.round(geo.polyline_length(), 6).alias("length"))


@query("polyline_straightness")
def q_polyline_straightness(spark, sf) -> DataFrame:
    return fx.polylines(spark, sf).select(*SCENE_KEY, "line_seq",
                                          F.round(geo.polyline_straightness(), 6).alias("r2"))


@query("point_near_polyline")
def q_point_near_polyline(spark, sf) -> DataFrame:
    """Each lane line against the ego position at the same time."""
    j = fx.lane_lines(spark, sf).join(fx.track(spark, sf), SCENE_KEY)
    return j.select(*SCENE_KEY, "TrackingID",
                    geo.point_near_polyline("BoundaryLineX", "BoundaryLineY", "PositionX",
                                            "PositionY", 0.1).alias("near_01"),
                    geo.point_near_polyline("BoundaryLineX", "BoundaryLineY", "PositionX",
                                            "PositionY", 0.5).alias("near_05"))


@query("straight_scene")
def q_straight_scene(spark, sf) -> DataFrame:
    s = geom.scene_straightness(fx.polylines(spark, sf), SCENE_KEY)
    return s.select(*SCENE_KEY, r6("straight_share"), "is_straight")


@query("straight_times")
def q_straight_times(spark, sf) -> DataFrame:
    return geom.straight_times(fx.polylines(spark, sf), SCENE_KEY)


@query("lane_change_validate")
def q_lane_change_validate(spark, sf) -> DataFrame:
    """J5 on pipeline-A windows (one row per window and matching line)."""
    out = lcp.lane_change_pipeline(fx.track(spark, sf), fx.track_intervals(spark, sf),
                                   fx.lane_lines(spark, sf))
    return out.select(*TG, "i", r6("lc_start"), r6("lc_end"))


@query("lane_change_pipeline")
def q_lane_change_pipeline(spark, sf) -> DataFrame:
    """L6 version A as exported rows (S7 shape)."""
    v = lcp.lane_change_pipeline(fx.track(spark, sf), fx.track_intervals(spark, sf),
                                 fx.lane_lines(spark, sf))
    return lcp.lane_change_export(v)


@query("lane_change_pipeline_padded")
def q_lane_change_pipeline_padded(spark, sf) -> DataFrame:
    """L6 version B: 10 s ego padding, thresholds (40, 80, 0.013, 0.2)."""
    v = lcp.lane_change_pipeline_padded(fx.track(spark, sf), fx.track_intervals(spark, sf),
                                        fx.lane_lines(spark, sf))
    return v.select(*TG, "i", r6("lc_start"), r6("lc_end"))


@query("lane_change_export")
def q_lane_change_export(spark, sf) -> DataFrame:
    v = lcp.lane_change_pipeline(fx.track(spark, sf), fx.track_intervals(spark, sf),
                                 fx.lane_lines(spark, sf))
    return lcp.lane_change_export(v).select("recording_id", "lc")


@query("boundary_cross_any")
def q_boundary_cross_any(spark, sf) -> DataFrame:
    return geom.boundary_cross_any(fx.track(spark, sf), fx.lane_lines(spark, sf),
                                   fx.track_intervals(spark, sf), TG)


# --- statistics and remaining filters ---------------------------------------------------


@query("signal_quantiles")
def q_signal_quantiles(spark, sf) -> DataFrame:
    """A4: quartiles per recording from the sketch.  The operator's default
    rank error is the original 0.01; here it is 1e-4 so the result equals
    the oracle's exact discrete quantiles (the 0.01 form is checked by rank
    error in the tests)."""
    return sts.signal_quantiles(fx.track(spark, sf), "Yaw", rel_error=0.0001, group=["recording_id"])


@query("signal_quantiles_default")
def q_signal_quantiles_default(spark, sf) -> DataFrame:
    """A4 at its default rank error 0.01, told by rank: whether a value's ranks
    (copies have several) come within ceil(n / 100) rows of the quartile's rank
    ceil(share * n)."""
    tr = fx.track(spark, sf).select("recording_id", "Yaw")
    q = sts.signal_quantiles(tr, "Yaw", group=["recording_id"])

    def within(name: str, share: float):
        below, upto = (F.sum(F.when(c, 1).otherwise(0)) for c in (F.col("Yaw") < F.col(name), F.col("Yaw") <= F.col(name)))
        n = F.count("Yaw")
        rank, error = F.ceil(n * share), F.ceil(n / 100)
        return ((below + 1 <= rank + error) & (upto >= rank - error)).alias(f"{name}_within")
    return tr.join(q, "recording_id").groupBy("recording_id").agg(
        F.count("Yaw").alias("n"), within("q25", 0.25), within("q75", 0.75))


@query("sketch_quantiles")
def q_sketch_quantiles(spark, sf) -> DataFrame:
    """A4, A6 from stored sketches: one row of sketches per recording is
    written, and the quartiles over each vehicle's recordings (by the last digit
    of their numbers) come from the merged sketches.  Told by rank and size:
    whether a quartile's ranks come within ceil(2 n / 100) rows of its rank, and
    the number of distinct values within 5 % of the true one."""
    tr = fx.track(spark, sf).select("recording_id", "PositionX")
    path = tb.scratch_path(spark, "sketches")
    tb.write_table(sts.signal_sketches(tr, ["PositionX"], ["recording_id"]), path, append=False)
    fleet = F.substring("recording_id", 6, 1).alias("fleet")
    q = sts.merged_quantiles(tb.read_table(spark, path).withColumn("fleet", fleet), group=["fleet"])
    j = tr.withColumn("fleet", fleet).join(q, "fleet")

    def within(name: str, share: float):
        below, upto = (F.sum(F.when(c, 1).otherwise(0)) for c in (F.col("PositionX") < F.col(name), F.col("PositionX") <= F.col(name)))
        rank, error = F.ceil(F.count("PositionX") * share), F.ceil(F.count("PositionX") / 50)
        return ((below + 1 <= rank + error) & (upto >= rank - error)).alias(f"{name}_within")
    true_n = F.count_distinct("PositionX")
    return j.groupBy("fleet").agg(
        F.first("n").alias("n"), F.first("least").alias("least"), F.first("greatest").alias("greatest"),
        within("q25", 0.25), within("q75", 0.75), (F.abs(F.first("n_distinct") - true_n) <= true_n * 0.05).alias("distinct_within"))


@query("gap_statistics")
def q_gap_statistics(spark, sf) -> DataFrame:
    """A4, A5, A6 on a signal with NaN and null values, which are missing."""
    tr = fx.gap_track(spark, sf)
    g = ["recording_id"]
    return (sts.signal_quantiles(tr, "Yaw", rel_error=0.0001, group=g)
            .join(sts.signal_extent(tr, ["Yaw", "PositionX"], g), g).join(sts.distinct_counts(tr, ["Yaw", "PositionX"], g), g))


@query("gap_histogram")
def q_gap_histogram(spark, sf) -> DataFrame:
    """A9 on a signal with NaN and null values."""
    return sts.signal_histogram(fx.gap_track(spark, sf), "PositionX", 20).select("bin", "bin_lo", "bin_hi", "count")


@query("gap_density")
def q_gap_density(spark, sf) -> DataFrame:
    """A10 on a signal with NaN and null values."""
    return sts.signal_density(fx.gap_track(spark, sf), "Yaw").select("g", r6("x"), r6("density"))


@query("signal_extent")
def q_signal_extent(spark, sf) -> DataFrame:
    return sts.signal_extent(fx.track(spark, sf), ["Yaw", "YawRate", "VelocityY"], ["recording_id"])


@query("distinct_counts")
def q_distinct_counts(spark, sf) -> DataFrame:
    return sts.distinct_counts(fx.gnss(spark, sf), ["recording_id", "country"])


@query("distinct_values")
def q_distinct_values(spark, sf) -> DataFrame:
    return sts.distinct_values(fx.road_types(spark, sf), ["tag_name_list"])


@query("recorded_hours")
def q_recorded_hours(spark, sf) -> DataFrame:
    return sts.recorded_hours(fx.file_meta(spark, sf)).select("total_seconds", r6("hours"))


@query("interval_list_explode")
def q_interval_list_explode(spark, sf) -> DataFrame:
    return ivs.explode_interval_list(fx.interval_lists(spark, sf))


@query("highway_hours")
def q_highway_hours(spark, sf) -> DataFrame:
    h = sts.interval_hours(ivs.explode_interval_list(fx.interval_lists(spark, sf)))
    return h.select(r6("total_seconds"), r6("hours"))


@query("signal_histogram")
def q_signal_histogram(spark, sf) -> DataFrame:
    h = sts.signal_histogram(fx.track(spark, sf), "YawRate", 20)
    return h.select("bin", "bin_lo", "bin_hi", "count")


@query("signal_histogram_fine")
def q_signal_histogram_fine(spark, sf) -> DataFrame:
    h = sts.signal_histogram(fx.track(spark, sf), "PositionX", 10000)
    return h.select("bin", "bin_lo", "bin_hi", "count")


@query("signal_density")
def q_signal_density(spark, sf) -> DataFrame:
    """A10 after F12: density of yaw rate where |yaw rate| > 0.005."""
    d = sts.signal_density(flt.turning_rows(fx.track(spark, sf)), "YawRate")
    return d.select("g", r6("x"), r6("density"))


@query("geo_centre")
def q_geo_centre(spark, sf) -> DataFrame:
    return sts.median_centre(fx.gnss(spark, sf)).select(r6("centre_lat"), r6("centre_lon"))


@query("geo_density")
def q_geo_density(spark, sf) -> DataFrame:
    return sts.geo_density(fx.gnss(spark, sf), cell=1.0)


@query("epoch_convert")
def q_epoch_convert(spark, sf) -> DataFrame:
    e = fx.track(spark, sf).select("recording_id", "ptp_time")
    ts = sts.epoch_to_timestamp("ptp_time")
    return e.select("recording_id", "ptp_time", F.date_format(F.to_utc_timestamp(ts, F.current_timezone()),
                                                              "yyyy-MM-dd HH:mm:ss.SSS").alias("ts_text"),
                    sts.timestamp_to_epoch(ts).alias("back"))


@query("drop_constant_columns")
def q_drop_constant_columns(spark, sf) -> DataFrame:
    return flt.drop_constant_columns(fx.signals(spark, sf))


@query("road_type_filter")
def q_road_type_filter(spark, sf) -> DataFrame:
    """F10 over every recording."""
    return flt.road_type_filter(fx.road_types(spark, sf))


@query("highway_times")
def q_highway_times(spark, sf) -> DataFrame:
    """O1: distinct (start, end) of each recording's highway tags, by start."""
    r = flt.road_type_filter(fx.road_types(spark, sf))
    return (r.select("recording_id", "start_datetime", "end_datetime").distinct()
            .orderBy("recording_id", "start_datetime"))


@query("country_split")
def q_country_split(spark, sf) -> DataFrame:
    g = flt.country_group(fx.gnss(spark, sf)).where("country_group is not null")
    return g.select("recording_id", "country", "country_group", "etrs89_latitude")


@query("odd_motion")
def q_odd_motion(spark, sf) -> DataFrame:
    return flt.odd_motion(fx.track(spark, sf))


@query("yaw_rate_filter")
def q_yaw_rate_filter(spark, sf) -> DataFrame:
    return flt.turning_rows(fx.track(spark, sf)).select("recording_id", "ptp_time", "YawRate")


@query("interval_pad")
def q_interval_pad(spark, sf) -> DataFrame:
    return flt.interval_pad(fx.track_intervals(spark, sf))


@query("time_slice")
def q_time_slice(spark, sf) -> DataFrame:
    """F6 on every recording: rows with 100 <= time <= 900."""
    return flt.time_slice(fx.track(spark, sf), 100.0, 900.0)


@query("time_slice_text")
def q_time_slice_text(spark, sf) -> DataFrame:
    """the same slice with bounds given as datetime text."""
    return flt.time_slice_text(fx.track(spark, sf), "1970-01-01 00:01:40.899",
                               "1970-01-01 00:15:00.500")


@query("first_rows")
def q_first_rows(spark, sf) -> DataFrame:
    """O2: first 10 rows in a total order (time, recording)."""
    return fx.track(spark, sf).orderBy("ptp_time", "recording_id").limit(10)


# --- tables, metadata, tags, sources -------------------------------------------------------


FIXED_DATE = "2024/01/01_00:00:00"


def _nation_keys(spark, sf):
    return spark.read.parquet(table_path(sf, "nation")).selectExpr(
        "n_nationkey AS key_no", "n_regionkey AS region", f"{fx.rec('n_nationkey')} AS recording_id")


@query("key_lookup")
def q_key_lookup(spark, sf) -> DataFrame:
    """Rows for (recording, file name) keys; recordings 0-4 are asked
    twice, null and empty names are matched as values."""
    keys = _nation_keys(spark, sf).selectExpr(
        "recording_id", "CASE WHEN region < 3 THEN CAST(NULL AS STRING) ELSE '' END AS filename_parquet")
    return tb.key_lookup(fx.file_meta(spark, sf), keys, ["recording_id", "filename_parquet"])


@query("key_exists")
def q_key_exists(spark, sf) -> DataFrame:
    keys = _nation_keys(spark, sf).selectExpr(
        "key_no", "CASE WHEN region = 2 THEN concat('missing_', cast(key_no AS string)) "
        "ELSE recording_id END AS recording_id", "CAST(NULL AS STRING) AS filename_parquet")
    return tb.key_exists(fx.file_meta(spark, sf), keys, ["recording_id", "filename_parquet"])


@query("key_exists_own")
def q_key_exists_own(spark, sf) -> DataFrame:
    """J9 with keys taken from the table itself."""
    meta = fx.file_meta(spark, sf)
    return tb.key_exists(meta, meta.where("file_id % 2 = 0").select("file_id", "recording_id", "filename_parquet"), ["recording_id", "filename_parquet"])


def _new_rows(spark, sf):
    return _nation_keys(spark, sf).selectExpr(
        "recording_id", "CAST(key_no AS DOUBLE) AS first_ptp_time",
        "CAST(key_no + 5 AS DOUBLE) AS last_ptp_time",
        "concat('new_', cast(key_no AS string), '.parquet') AS filename_parquet", "-key_no - 1 AS file_id")


@query("replace_rows")
def q_replace_rows(spark, sf) -> DataFrame:
    keys = _nation_keys(spark, sf).where("region = 0")
    return tb.replace_rows(fx.file_meta(spark, sf).withColumn("write_date", F.lit(FIXED_DATE)),
                           _new_rows(spark, sf), keys, ["recording_id"], date_col="write_date",
                           when=FIXED_DATE)


@query("update_by_key")
def q_update_by_key(spark, sf) -> DataFrame:
    keys = _nation_keys(spark, sf).where("region = 1")
    return tb.update_by_key(fx.file_meta(spark, sf),
                            {"filename_parquet": "updated.parquet", "last_ptp_time": 0.0},
                            keys, ["recording_id"])


def _stored_meta(spark, sf) -> str:
    path = tb.scratch_path(spark, "meta_store")
    tb.write_partitioned(fx.file_meta(spark, sf).withColumn("write_date", F.lit(FIXED_DATE)), path, ["recording_id"])
    return path


@query("replace_in_store")
def q_replace_in_store(spark, sf) -> DataFrame:
    """T1 on a stored table with a folder per recording: only folders that hold
    a key or take a new row are written anew."""
    path = _stored_meta(spark, sf)
    tb.replace_in_store(spark, path, ["recording_id"], _new_rows(spark, sf).where("file_id > -15"),
                        _nation_keys(spark, sf).where("region = 0"), ["recording_id"], date_col="write_date", when=FIXED_DATE)
    return tb.read_table(spark, path)


@query("update_in_store")
def q_update_in_store(spark, sf) -> DataFrame:
    """T2 on a stored table, with keys taken from the table itself."""
    path = _stored_meta(spark, sf)
    keys = tb.read_table(spark, path).where("filename_parquet = ''")
    tb.update_in_store(spark, path, ["recording_id"], {"filename_parquet": "unnamed", "last_ptp_time": 0.0}, keys, ["file_id"])
    return tb.read_table(spark, path)


@query("table_scan")
def q_table_scan(spark, sf) -> DataFrame:
    return tb.read_table(spark, table_path(sf, "orders"))


@query("table_write_roundtrip")
def q_table_write_roundtrip(spark, sf) -> DataFrame:
    """Replace-write with a date column and a history append, read back."""
    path = tb.scratch_path(spark, "file_meta")
    tb.write_table(fx.file_meta(spark, sf), path, append=False, date_col="write_to_db_date",
                   when=FIXED_DATE, history=True)
    return tb.read_table(spark, path)


@query("metadata_outer_union")
def q_metadata_outer_union(spark, sf) -> DataFrame:
    old = fx.file_meta(spark, sf).select("recording_id", "first_ptp_time", "file_id")
    new = fx.gnss(spark, sf).select("recording_id", "country", F.lit(1).alias("Column1"))
    return tb.outer_union(old, new, drop=("Column1",))


@query("annotation_parse")
def q_annotation_parse(spark, sf) -> DataFrame:
    return md.parse_annotations(fx.annotations(spark, sf))


SAMPLE_MAPPING = "1: body, 2: chassis"


@query("metadata_build")
def q_metadata_build(spark, sf) -> DataFrame:
    return md.metadata_build(md.parse_annotations(fx.annotations(spark, sf)), dbc_mapping=SAMPLE_MAPPING)


@query("recording_id_parts")
def q_recording_id_parts(spark, sf) -> DataFrame:
    return md.recording_id_parts(fx.file_meta(spark, sf).select("recording_id").distinct())


@query("path_recording_id")
def q_path_recording_id(spark, sf) -> DataFrame:
    p = fx.annotations(spark, sf).select("path").distinct()
    return p.select("path", md.path_recording_id(F.col("path")).alias("recording_id"))


@query("tag_filter")
def q_tag_filter(spark, sf) -> DataFrame:
    """T4 by tag names over every recording."""
    return tg.tag_filter(fx.tags(spark, sf), ["click", "view"])


@query("tag_page")
def q_tag_page(spark, sf) -> DataFrame:
    return tg.tag_page(fx.tags(spark, sf), offset=5000)


@query("tag_page_next")
def q_tag_page_next(spark, sf) -> DataFrame:
    """O3 by key: the page after tag 1000."""
    return tg.tag_page_after(fx.tags(spark, sf), (1000,))


@query("tag_ranked_page")
def q_tag_ranked_page(spark, sf) -> DataFrame:
    """O3 by rank: tags in the order of their start, then id; 700 tags from
    place 900, read from the ranges that hold them."""
    path = tb.scratch_path(spark, "ranked_tags")
    tg.write_ranked(fx.tags(spark, sf), path, ("start_time", "tag_id"))
    return tg.ranked_page(spark, path, 900, 700)


@query("tag_json_flatten")
def q_tag_json_flatten(spark, sf) -> DataFrame:
    """X7 with the columns found in the data."""
    flat = tg.json_flatten(fx.load(spark, sf, "json_tag"), "item")
    return flat.withColumn("marks", F.to_json("marks"))


@query("tag_flatten")
def q_tag_flatten(spark, sf) -> DataFrame:
    return tg.tag_flatten(fx.tags(spark, sf), "props", "struct<k:int>")


@query("tag_overlap")
def q_tag_overlap(spark, sf) -> DataFrame:
    """T5: time tagged 'click' and 'view' and not 'error'."""
    return tg.tag_overlap(fx.tags(spark, sf), ["click", "view"], ["error"])


@query("scan_recording")
def q_scan_recording(spark, sf) -> DataFrame:
    """Store the track stream partitioned by recording, read it back."""
    root = tb.scratch_path(spark, "streams")
    rc.write_recordings(fx.track(spark, sf), root, "reference", "ego")
    return rc.scan_recording(spark, root, "reference", "ego")


@query("scan_one_recording")
def q_scan_one_recording(spark, sf) -> DataFrame:
    """S1 for one recording (the first by name): reads its folder only."""
    root = tb.scratch_path(spark, "streams")
    tr = fx.track(spark, sf)
    rc.write_recordings(tr, root, "reference", "ego")
    first = tr.agg(F.min("recording_id")).first()[0]
    return rc.scan_recording(spark, root, "reference", "ego", first)


@query("table_append_history")
def q_table_append_history(spark, sf) -> DataFrame:
    """Replace, then append, both with history; table and history read back."""
    path = tb.scratch_path(spark, "file_meta")
    meta = fx.file_meta(spark, sf)
    for append in (False, True):
        tb.write_table(meta, path, append=append, date_col="write_to_db_date", when=FIXED_DATE, history=True)
    return (tb.read_table(spark, path).withColumn("part", F.lit("table"))
            .unionByName(tb.read_table(spark, path + "_history").withColumn("part", F.lit("history"))))


@query("lane_change_csv")
def q_lane_change_csv(spark, sf) -> DataFrame:
    """S7 written as CSV and read back."""
    path = tb.scratch_path(spark, "lane_change_csv")
    v = lcp.lane_change_pipeline(fx.track(spark, sf), fx.track_intervals(spark, sf),
                                 fx.lane_lines(spark, sf))
    lcp.write_lane_changes(lcp.lane_change_export(v), path)
    return spark.read.schema("recording_id string, lc string").option("header", True).csv(path)


@query("csv_signal_scan")
def q_csv_signal_scan(spark, sf) -> DataFrame:
    """S3: signals exported as CSV with an index column, read back."""
    path = tb.scratch_path(spark, "signal_csv")
    tr = fx.track(spark, sf)
    rc.write_signal_csv(tr, path)
    return rc.read_signal_csv(spark, path, schema=tr.schema)


@query("interval_load")
def q_interval_load(spark, sf) -> DataFrame:
    """Intervals exported as a flat CSV, read back with a declared schema."""
    path = tb.scratch_path(spark, "interval_csv")
    fx.intervals(spark, sf).write.mode("overwrite").option("header", True).csv(path)
    return ivs.read_interval_csv(spark, path)


@query("straight_scene_old")
def q_straight_scene_old(spark, sf) -> DataFrame:
    """A12 with the older thresholds (R2 > 0.94, share > 0.5)."""
    s = geom.scene_straightness(fx.polylines(spark, sf), SCENE_KEY, r2_min=STRAIGHT_R2_MIN_OLD,
                                share_min=STRAIGHT_SHARE_MIN_OLD)
    return s.select(*SCENE_KEY, r6("straight_share"), "is_straight")
