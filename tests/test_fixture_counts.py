"""Counts that FIXTURES.md reports for the derived tables at sf0.001."""

import duckdb
from helpers import scan_loop
from pyspark.sql import functions as F

from trajex.operators import filters as flt
from trajex.operators import labels as lab
from trajex.operators import sequence as seq
from trajex.plans import lane_change as lcp
from trajex.plans import queries as qm
from trajex.plans import scenario as scn
from trajex.schema import SCAN_BASIC, SCAN_LONG, SCAN_PIPELINE_A, SCAN_PIPELINE_B, ScanParams
from trajex.sources import fixtures as fx


def test_scene_counts(spark, sf_small):
    inp = qm.scene_inputs(spark, sf_small)
    assert inp.ego.count() == 1500
    assert flt.highway_filter(inp.ego, inp.intervals).count() == 482
    assert inp.objects.count() == 6000
    assert flt.highway_filter(inp.objects, inp.intervals).count() == 3542
    ego, obj, st = scn.prepared(inp)
    assert obj.count() == 1297
    assert [lab.label_lane_change(st).count(), lab.label_emergency_brake(st).count(),
            lab.label_turning(st).count(),
            lab.label_congestion(lab.scene_summary(obj, ego)).count()] == [470, 301, 108, 1]
    counts = dict(lab.label_counts(scn.scenario_labels(inp)).collect())
    assert [counts.get(k, 0) for k in range(5)] == [359, 422, 374, 137, 5]


def test_track_counts(spark, sf_small):
    tr = fx.track(spark, sf_small)
    assert int(seq.position_stitch(tr, ["recording_id"]).agg(F.sum(F.col("_jump").cast("int"))).first()[0]) == 20
    assert fx.lane_lines(spark, sf_small).count() == 3000
    tin = qm.track_in_intervals(spark, sf_small)
    groups = {}
    for r in tin.select("recording_id", "id", "ptp_time", "Yaw").collect():
        groups.setdefault((r.recording_id, r.id), []).append((r.ptp_time, r.Yaw))
    con = duckdb.connect()
    want = con.sql(f"""
        SELECT count(*) FROM '{sf_small}/orders.parquet' JOIN '{sf_small}/supplier.parquet'
        ON o_custkey % 20 = s_suppkey % 20 AND o_orderkey / 8.0 BETWEEN s_suppkey * 18.75 AND s_suppkey * 18.75 + 700""").fetchall()[0][0]
    assert sum(map(len, groups.values())) == want
    g = ["recording_id", "id"]
    for spec in (SCAN_BASIC, SCAN_PIPELINE_A, SCAN_PIPELINE_B, SCAN_LONG):
        p = ScanParams.of(spec)
        loops = sum(len(scan_loop([v for _, v in sorted(rows)], p.minimum, p.maximum, p.lo, p.hi, p.tol, p.jump))
                    for rows in groups.values())
        assert seq.yaw_return_scan(tin, g, p).count() == loops


def test_intervals_reach_the_end_of_the_track(spark):
    """Rows in intervals grow with the data."""
    n = [qm.track_in_intervals(spark, f"/root/testdata/{sf}").count() for sf in ("sf0.01", "sf0.1")]
    assert 8 <= n[1] / n[0] <= 13


def test_validation_counts(spark):
    # counts of the oracle SQL in DuckDB at sf0.01
    sf = "/root/testdata/sf0.01"
    assert qm.Q["lane_change_validate"](spark, sf).count() == 116
    valid = lcp.lane_change_pipeline(fx.track(spark, sf), fx.track_intervals(spark, sf), fx.lane_lines(spark, sf))
    assert valid.count() == 116
    assert qm.Q["lane_change_pipeline"](spark, sf).count() == 54  # recordings with a list of windows


def test_other_fixture_counts(spark, sf_small):
    from trajex.operators import geometry as geom
    from trajex.operators import tags as tg
    s = geom.scene_straightness(fx.polylines(spark, sf_small), ["recording_id", "ptp_time"])
    assert (s.where("is_straight").count(), s.count()) == (151, 187)
    assert tg.tag_overlap(fx.tags(spark, sf_small), ["click", "view"], ["error"]).count() == 88
    ann = fx.annotations(spark, sf_small)
    assert (ann.select("path").distinct().count(), ann.count()) == (20, 87)


def test_chunked_paths_equal_single_task_paths(spark, sf_small):
    from trajex.operators import tags as tg
    tr = fx.track(spark, sf_small)

    def rows(df, cols):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                      for r in df.select(*cols).collect())
    cols = ["recording_id", "row_no", "PositionX", "PositionY", "PositionZ"]
    assert rows(seq.position_stitch(tr, ["recording_id"], chunk=7), cols) == \
        rows(seq.position_stitch(tr, ["recording_id"]), cols)
    hcols = ["recording_id", "row_no", "angle"]
    assert rows(seq.heading(tr, ["recording_id"], chunk=9), hcols) == \
        rows(seq.heading(tr, ["recording_id"]), hcols)
    t = fx.tags(spark, sf_small)
    ocols = ["recording_id", "start_time", "end_time"]
    assert rows(tg.tag_overlap(t, ["click", "view"], ["error"], chunk=4), ocols) == \
        rows(tg.tag_overlap(t, ["click", "view"], ["error"]), ocols)
