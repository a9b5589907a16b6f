import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from trajex.functions import geometry as geo
from trajex.operators import geometry as geom


def _one(spark, x, y, expr):
    df = spark.createDataFrame([Row(BoundaryLineX=x, BoundaryLineY=y, px=0.0, py=0.0)],
                               "BoundaryLineX array<double>, BoundaryLineY array<double>, px double, py double")
    return df.select(expr.alias("v")).first().v


def test_length_degenerate(spark):
    assert _one(spark, [], [], geo.polyline_length()) == 0.0
    assert _one(spark, [1.0], [1.0], geo.polyline_length()) == 0.0
    assert _one(spark, [0.0, 3.0, 3.0], [0.0, 4.0, 5.0], geo.polyline_length()) == 6.0
    # arrays of different length are zipped to the shorter one
    assert _one(spark, [0.0, 3.0, 9.0], [0.0, 4.0], geo.polyline_length()) == 5.0


def test_straightness_degenerate(spark):
    r2 = geo.polyline_straightness()
    assert _one(spark, [0.0, 1.0], [0.0, 5.0], r2) == 1.0           # two points
    assert _one(spark, [0.0, 1.0, 2.0], [3.0, 3.0, 3.0], r2) == 1.0  # constant y
    assert _one(spark, [1.0, 1.0, 1.0], [0.0, 1.0, 2.0], r2) == 0.0  # constant x
    assert abs(_one(spark, [0.0, 1.0, 2.0, 3.0], [0.0, 1.0, 2.0, 3.0], r2) - 1.0) < 1e-12
    v = _one(spark, [0.0, 1.0, 2.0, 3.0], [0.0, 1.0, 0.0, 1.0], r2)
    assert abs(v - 0.2) < 1e-12


def test_point_near_polyline(spark):
    near = lambda d: geo.point_near_polyline("BoundaryLineX", "BoundaryLineY", "px", "py", d)
    assert _one(spark, [1.0], [0.0], near(5.0)) is False          # one point
    assert _one(spark, [-1.0, 1.0], [0.05, 0.05], near(0.1)) is True
    assert _one(spark, [-1.0, 1.0], [0.15, 0.15], near(0.1)) is False
    assert _one(spark, [0.3, 1.0], [0.0, 0.0], near(0.5)) is True   # near the end point
    assert _one(spark, [0.6, 1.0], [0.0, 0.0], near(0.5)) is False
    assert _one(spark, [1.0, 1.0], [1.0, 1.0], near(2.0)) is True   # zero-length segment


def test_validate_two_lines_give_two_rows(spark):
    ego = spark.createDataFrame([Row(recording_id="r", id=0, ptp_time=t, PositionX=0.0, PositionY=0.0)
                                 for t in (1.0, 2.0, 3.0)])
    win = spark.createDataFrame([Row(recording_id="r", id=0, i=0, lc_start=1.5, lc_end=3.0)])
    lines = spark.createDataFrame([
        Row(recording_id="r", ptp_time=2.0, TrackingID=0, BoundaryLineX=[-1.0, 1.0], BoundaryLineY=[0.05, 0.05]),
        Row(recording_id="r", ptp_time=2.0, TrackingID=1, BoundaryLineX=[-1.0, 1.0], BoundaryLineY=[-0.05, -0.05]),
        Row(recording_id="r", ptp_time=2.0, TrackingID=2, BoundaryLineX=[-1.0, 1.0], BoundaryLineY=[0.5, 0.5]),
        Row(recording_id="r", ptp_time=3.0, TrackingID=0, BoundaryLineX=[-1.0, 1.0], BoundaryLineY=[0.0, 0.0])])
    out = geom.lane_change_validate(win, ego, lines, ["recording_id", "id"])
    assert out.count() == 2
    assert geom.lane_change_validate(win, ego, lines, ["recording_id", "id"], distinct=True).count() == 1
    assert geom.lane_change_validate(win, ego, lines, ["recording_id", "id"], first_only=False).count() == 3


def test_cross_any_needs_a_later_line(spark):
    ego = spark.createDataFrame([Row(recording_id="r", ptp_time=5.0, PositionX=10.0, PositionY=0.0)])
    sl = spark.createDataFrame([Row(recording_id="r", id=0, start_time=0.0, end_time=100.0)])
    earlier = spark.createDataFrame([Row(recording_id="r", ptp_time=4.0, BoundaryLineX=[9.0, 11.0],
                                         BoundaryLineY=[0.2, 0.2])])
    later = earlier.withColumn("ptp_time", F.lit(6.0))
    k = ["recording_id", "id"]
    assert geom.boundary_cross_any(ego, earlier, sl, k).first().crossed is False
    assert geom.boundary_cross_any(ego, later, sl, k).first().crossed is True


def test_straight_scene_zero_length_is_not_straight(spark):
    rows = [Row(recording_id="r", ptp_time=0.0, BoundaryLineX=[1.0], BoundaryLineY=[1.0])]
    out = geom.scene_straightness(spark.createDataFrame(rows), ["recording_id", "ptp_time"]).first()
    assert out.straight_share is None and out.is_straight is False


def test_cross_any_stopped_vehicle_cell(spark):
    import random
    rnd = random.Random(1)
    # 300 jittering fixes around (10, 0) and lane lines 1.75 m to each side
    ego = spark.createDataFrame([Row(recording_id="r", ptp_time=float(k) / 10, PositionX=10 + rnd.uniform(-0.05, 0.05),
                                     PositionY=rnd.uniform(-0.05, 0.05)) for k in range(300)])
    side = [Row(recording_id="r", ptp_time=float(k) / 10, BoundaryLineX=[5.0, 15.0], BoundaryLineY=[y, y])
            for k in range(300) for y in (1.75, -1.75)]
    sl = spark.createDataFrame([Row(recording_id="r", id=0, start_time=0.0, end_time=100.0)])
    k = ["recording_id", "id"]
    assert geom.boundary_cross_any(ego, spark.createDataFrame(side), sl, k).first().crossed is False
    cross = side + [Row(recording_id="r", ptp_time=29.0, BoundaryLineX=[9.0, 11.0], BoundaryLineY=[0.3, 0.3])]
    assert geom.boundary_cross_any(ego, spark.createDataFrame(cross), sl, k).first().crossed is True


def test_export_lists_windows_in_order_with_repeats(spark):
    from trajex.plans import lane_change as lcp
    v = spark.createDataFrame([Row(recording_id="r", id=0, i=50, lc_start=20.5, lc_end=32.5),
                               Row(recording_id="r", id=0, i=3, lc_start=1.0, lc_end=13.0),
                               Row(recording_id="r", id=0, i=3, lc_start=1.0, lc_end=13.0),
                               Row(recording_id="s", id=1, i=7, lc_start=2.25, lc_end=14.25)])
    got = {(r.recording_id, r.id): (r.n_windows, r.lc) for r in lcp.lane_change_export(v).collect()}
    assert got[("r", 0)] == (3, "[(1.0, 13.0), (1.0, 13.0), (20.5, 32.5)]")
    assert got[("s", 1)] == (1, "[(2.25, 14.25)]")


def test_cross_any_equals_all_pairs(spark):
    import math
    import random
    rnd = random.Random(4)

    def near(px, py, ax, ay, bx, by):
        dx, dy = bx - ax, by - ay
        d = dx * dx + dy * dy
        t = max(0.0, min(1.0, ((px - ax) * dx + (py - ay) * dy) / d)) if d else 0.0
        return math.hypot(px - ax - t * dx, py - ay - t * dy) < 0.5
    ego, lines = [], []
    for s in range(60):
        rid = f"r{s}"
        for _ in range(25):
            ego.append((rid, rnd.uniform(0, 50), rnd.uniform(-20, 20), rnd.uniform(-20, 20)))
        for _ in range(3):
            a = [rnd.uniform(-30, 30) for _ in range(4)]
            if rnd.random() < 0.2:
                a[2] = a[0]  # upright
            lines.append((rid, rnd.uniform(0, 50), [a[0], a[2]], [a[1], a[3]]))
    want = {f"r{s}": any(e[0] == ln[0] == f"r{s}" and ln[1] > e[1] and near(e[2], e[3], ln[2][0], ln[3][0], ln[2][1], ln[3][1])
                         for e in ego for ln in lines) for s in range(60)}
    got = geom.boundary_cross_any(
        spark.createDataFrame(ego, "recording_id string, ptp_time double, PositionX double, PositionY double"),
        spark.createDataFrame(lines, "recording_id string, ptp_time double, BoundaryLineX array<double>, BoundaryLineY array<double>"),
        spark.createDataFrame([(f"r{s}", 0, 0.0, 100.0) for s in range(60)],
                              "recording_id string, id int, start_time double, end_time double"), ["recording_id", "id"])
    assert {r.recording_id: r.crossed for r in got.collect()} == want
    assert 5 < sum(want.values()) < 55


def test_segment_cells_follow_a_long_segment(spark):
    seg = spark.createDataFrame([(0.0, 0.0, 1000.0, 1000.0, -5000.0, -5000.0, 5000.0, 5000.0),
                                 (0.0, 0.0, 1000.0, 1000.0, 10.0, 10.0, 14.0, 14.0)],
                                "ax double, ay double, bx double, by double, _x0 double, _y0 double, _x1 double, _y1 double")
    n = {r._x0: r.n for r in geom.segment_cells(seg, 0.5, 2.0).groupBy("_x0").agg(F.count("*").alias("n")).collect()}
    assert n[-5000.0] < 2100  # the box of the segment has 250,000 cells
    assert n[10.0] <= 9


def stopped(spark, n):
    """A vehicle that jitters about one place, and lines around it at about the
    buffer's distance, recorded later."""
    import random
    rnd = random.Random(n)
    ego = [("r", k * 0.1, rnd.gauss(0, 0.02), rnd.gauss(0, 0.02)) for k in range(n)]
    lines = [("r", 100000.0 + k, [-5.0, 5.0], [0.75 + rnd.uniform(0, 0.2)] * 2) for k in range(n)]
    return (spark.createDataFrame(ego, "recording_id string, ptp_time double, PositionX double, PositionY double"),
            spark.createDataFrame(lines, "recording_id string, ptp_time double, BoundaryLineX array<double>, BoundaryLineY array<double>"),
            spark.createDataFrame([("r", 0, -1.0, 1e9)], "recording_id string, id int, start_time double, end_time double"))


@pytest.mark.parametrize("pairs", [1, 50, 100_000])
def test_dense_cells_are_cut_and_answers_stay(spark, pairs):
    ego, lines, sl = stopped(spark, 60)
    for buffer in (0.1, 0.3, 0.74, 0.8, 2.0):
        got = geom.boundary_cross_any(ego, lines, sl, ["recording_id", "id"], buffer=buffer, pairs=pairs).first().crossed
        e = [(r.PositionX, r.PositionY) for r in ego.collect()]
        want = any(abs(y - ln.BoundaryLineY[0]) < buffer for _, y in e for ln in lines.collect())
        assert got == want


def test_a_stopped_vehicle_makes_no_pairs(spark):
    """Lines clearly beyond the buffer of a crowded cell, or clearly within it,
    are decided by the cell's box."""
    ego, lines, sl = stopped(spark, 3000)
    assert geom.boundary_cross_any(ego, lines, sl, ["recording_id", "id"], buffer=0.3, pairs=1000).first().crossed is False
    assert geom.boundary_cross_any(ego, lines, sl, ["recording_id", "id"], buffer=1.5, pairs=1000).first().crossed is True
