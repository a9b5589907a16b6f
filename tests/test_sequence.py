import random

import pytest
from helpers import scan_loop, stitch_loop
from pyspark.sql import Row

from trajex.operators import sequence as seq
from trajex.schema import SCAN_BASIC, SCAN_LONG, SCAN_PIPELINE_A, ScanParams


def _frame(spark, groups):
    rows = [Row(recording_id=g, id=0, ptp_time=float(t) / 10, Yaw=float(v))
            for g, vals in groups.items() for t, v in enumerate(vals)]
    return spark.createDataFrame(rows)


def _run(spark, groups, spec, chunk=seq.CHUNK_ROWS):
    df = _frame(spark, groups)
    got = seq.yaw_return_scan(df, ["recording_id", "id"], ScanParams.of(spec), chunk=chunk)
    return sorted((r.recording_id, r.i, r.j) for r in got.collect())


def _expect(groups, spec):
    p = ScanParams.of(spec)
    return sorted((g, i, j) for g, vals in groups.items()
                  for i, j in scan_loop(vals, p.minimum, p.maximum, p.lo, p.hi))


def test_no_match_and_flat(spark):
    groups = {"flat": [0.0] * 200, "short": [0.0, 0.05]}
    assert _run(spark, groups, SCAN_BASIC) == []


def test_close_match_takes_two_steps_and_hides_later(spark):
    # row 0 returns to its value at row 4 with the middle far enough:
    # a too-close first match (4 < 40); the scan moves by 2, not 41
    vals = [0.0] * 120
    vals[2] = 0.05
    for k in range(50, 60):
        vals[k] = 0.05
    assert _expect({"g": vals}, SCAN_BASIC) == _run(spark, {"g": vals}, SCAN_BASIC)


def test_exact_minimum_and_group_end(spark):
    # the first return of row 0 is exactly 40 rows on: accepted
    vals = [0.0] + [0.05] * 39 + [0.0] + [0.05] * 10
    res = _run(spark, {"g": vals}, SCAN_BASIC)
    assert res == _expect({"g": vals}, SCAN_BASIC)
    assert res[0][1:] == (0, 40)
    # the return sits on the group's last row: still found
    tail = [0.0] + [0.05] * 39 + [0.0]
    assert _run(spark, {"g": tail}, SCAN_BASIC) == [("g", 0, 40)]


def test_middle_parity_rounds_half_to_even(spark):
    # i + j odd: middle is the even neighbour; make only the odd one qualify
    for odd_mid_ok in (True, False):
        vals = [0.0] * 80
        j = 41   # (0 + 41) / 2 = 20.5 -> 20 (even)
        vals[21 if odd_mid_ok else 20] = 0.05
        vals[j] = 0.0
        got = _run(spark, {"g": vals}, SCAN_BASIC)
        assert got == _expect({"g": vals}, SCAN_BASIC)


@pytest.mark.parametrize("spec", [SCAN_BASIC, SCAN_PIPELINE_A, SCAN_LONG])
@pytest.mark.parametrize("chunk", [seq.CHUNK_ROWS, 160, 233])
def test_random_groups_match_loop_any_chunk(spark, spec, chunk):
    rnd = random.Random(7)
    groups = {}
    for g in range(6):
        n = rnd.randint(50, 700)
        groups[f"r{g}"] = [rnd.randint(0, 12) / 300.0 for _ in range(n)]
    assert _run(spark, groups, spec, chunk) == _expect(groups, spec)


def test_emitted_starts_are_41_apart(spark):
    rnd = random.Random(3)
    vals = [rnd.randint(0, 8) / 400.0 for _ in range(900)]
    got = [i for _, i, _ in _run(spark, {"g": vals}, SCAN_PIPELINE_A, chunk=200)]
    assert all(b - a >= 41 for a, b in zip(got, got[1:]))


def test_number_rows_matches_row_number(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rows = [Row(g=g, t=float(t) * 7.3) for g in range(3) for t in range(400)]
    df = spark.createDataFrame(rows)
    a = seq.number_rows(df, ["g"], ["t"], bucket_seconds=50.0)
    b = df.withColumn("_i", F.row_number().over(Window.partitionBy("g").orderBy("t")) - 1)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


@pytest.mark.parametrize("chunk", [seq.CHUNK_ROWS, 5])
def test_position_stitch_two_jumps(spark, chunk):
    xs = [0.0, 1.0, 2.0, 50.0, 51.0, 52.0, 53.0, 5.0, 6.0, 7.0, 8.0, 9.0]
    ys = [0.0] * len(xs)
    zs = [float(k) for k in range(len(xs))]
    df = spark.createDataFrame([Row(recording_id="r", ptp_time=float(k), PositionX=x, PositionY=y,
                                    PositionZ=z) for k, (x, y, z) in enumerate(zip(xs, ys, zs))])
    got = seq.position_stitch(df, ["recording_id"], chunk=chunk).orderBy("ptp_time").collect()
    X, Y, Z = stitch_loop(xs, ys, zs)
    assert [r.PositionX for r in got] == X
    assert [r.PositionZ for r in got] == Z
    assert sum(r._jump for r in got) == 2


def test_position_stitch_without_jumps_is_identity(spark):
    df = spark.createDataFrame([Row(recording_id="r", ptp_time=float(k), PositionX=float(k),
                                    PositionY=1.0, PositionZ=2.0) for k in range(30)])
    got = seq.position_stitch(df, ["recording_id"]).orderBy("ptp_time").collect()
    assert [r.PositionX for r in got] == [float(k) for k in range(30)]


def test_heading_first_rows_and_short_group(spark):
    import math
    rows = [Row(recording_id="a", ptp_time=float(k), PositionX=float(k), PositionY=float(k) * 2)
            for k in range(10)]
    rows += [Row(recording_id="b", ptp_time=float(k), PositionX=float(k), PositionY=0.0) for k in range(4)]
    got = {(r.recording_id, r.row_no): r.angle
           for r in seq.heading(spark.createDataFrame(rows), ["recording_id"], chunk=6).collect()}
    a = math.atan2(10.0, 5.0)
    assert all(abs(got[("a", k)] - a) < 1e-12 for k in range(10))
    assert all(got[("b", k)] is None for k in range(4))


def test_containment_never_adds_rows(spark):
    short = spark.createDataFrame([Row(recording_id="r", id=0, t_i=1.0, t_j=2.0),
                                   Row(recording_id="r", id=0, t_i=5.0, t_j=9.0)])
    long = spark.createDataFrame([Row(recording_id="r", id=0, t_i=0.5, t_j=3.0),
                                  Row(recording_id="r", id=0, t_i=0.0, t_j=2.5)])
    out = seq.containment_anti(short, long, ["recording_id", "id"]).collect()
    assert [(r.t_i, r.t_j) for r in out] == [(5.0, 9.0)]


def test_polyline_merge_runs(spark):
    rows = [Row(recording_id="r", ptp_time=0.0, line_seq=k, TrackingID=tid,
                BoundaryLineX=[float(k)], BoundaryLineY=[float(k) * 10])
            for k, tid in enumerate([1, 1, 2, 1, 1, 1])]
    out = seq.polyline_merge(spark.createDataFrame(rows), ["recording_id", "ptp_time"]).orderBy("run_no")
    got = [(r.TrackingID, r.BoundaryLineX) for r in out.collect()]
    assert got == [(1, [0.0, 1.0]), (2, [2.0]), (1, [3.0, 4.0, 5.0])]


def test_nan_and_null_values_compare_false(spark):
    import math
    rnd = random.Random(5)
    vals = [rnd.randint(0, 6) / 300.0 for _ in range(400)]
    for k in range(0, 400, 13):
        vals[k] = float("nan")
    got = _run(spark, {"g": vals}, SCAN_BASIC)
    assert got == _expect({"g": vals}, SCAN_BASIC)
    assert _run(spark, {"g": vals}, SCAN_LONG, chunk=160) == _expect({"g": vals}, SCAN_LONG)
    assert any(math.isnan(v) for v in vals)


@pytest.mark.parametrize("chunk", [3, 1 << 16])
def test_null_times_and_groups_keep_their_rows(spark, chunk):
    rows = [("g", float(k), float(k), 0.0, 0.0) for k in range(10)] + [("g", None, 50.0, 0.0, 0.0)]
    rows += [(None, float(k), float(k % 3) * 30, 1.0, 0.0) for k in range(10)]
    df = spark.createDataFrame(rows, "recording_id string, ptp_time double, PositionX double, PositionY double, PositionZ double")
    got = seq.position_stitch(df, ["recording_id"], chunk=chunk).collect()
    assert sorted((str(r.recording_id), r.row_no) for r in got) == sorted(
        [("g", k) for k in range(11)] + [("None", k) for k in range(10)])
    xs = [x for _, _, x, _, _ in sorted(rows[11:], key=lambda r: r[1])]
    want = stitch_loop(xs, [1.0] * 10, [0.0] * 10)[0]
    assert [r.PositionX for r in sorted((r for r in got if r.recording_id is None), key=lambda r: r.row_no)] == want
    assert seq.heading(df, ["recording_id"], chunk=max(chunk, 20)).count() == len(rows)


def test_scan_keeps_null_groups(spark):
    yaw = [0.0, 0.02, 0.0] * 60
    rows = [(g, float(k), y) for g in ("a", None) for k, y in enumerate(yaw)]
    df = spark.createDataFrame(rows, "recording_id string, ptp_time double, Yaw double")
    p = ScanParams(minimum=2, maximum=5, lo=0.01, hi=0.1)
    found = [seq.yaw_return_scan(df, ["recording_id"], p, chunk=c).collect() for c in (50, 1 << 16)]
    assert sorted(map(str, found[0])) == sorted(map(str, found[1]))
    assert {r.recording_id for r in found[0]} == {"a", None}


def test_recentre_keeps_recordings_without_reference(spark):
    df = spark.createDataFrame([("a", 1.0, 5.0, 6.0), ("a", 2.0, 7.0, 8.0), ("b", 1.0, 1.0, 1.0)],
                               "recording_id string, ptp_time double, PositionX double, PositionY double")
    ref = spark.createDataFrame([("a", 1.0)], "recording_id string, ref_time double")
    got = {(r.recording_id, r.ptp_time): r.AdjustedPositionX for r in seq.pose_recentre(df, ref).collect()}
    assert got == {("a", 1.0): 0.0, ("a", 2.0): 2.0, ("b", 1.0): None}


def test_containment_equals_all_pairs(spark):
    rnd = random.Random(8)

    def windows(n, most):
        out = []
        for _ in range(n):
            a = rnd.choice([rnd.uniform(-100, 400), float(rnd.randint(-2, 6) * 60)])
            out.append((rnd.choice(["r", "s", None]), a, a + rnd.uniform(0, most)))
        return out
    short, long = windows(300, 20) + [("r", None, 5.0)], windows(80, 200) + [("r", None, 5.0), ("s", 0.0, None)]
    schema = "g string, t_i double, t_j double"
    got = seq.containment_anti(spark.createDataFrame(short, schema), spark.createDataFrame(long, schema), ["g"])
    want = [s for s in short if s[0] is None or s[1] is None or not any(
        b[0] == s[0] and None not in b and b[1] <= s[1] and b[2] >= s[2] for b in long)]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


@pytest.mark.parametrize("limit", [3, 40])
def test_cells_split_whatever_repeats(spark, limit):
    """Equal times, null times and rows equal in every order column."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    rows = [("g", 5.0, float(k % 7)) for k in range(150)] + [("g", None, float(k)) for k in range(90)] + [("g", 6.0, 1.0)] * 60
    rows += [("h", float(k) * 9, 0.0) for k in range(30)] + [(None, float("nan"), 2.0)] * 5
    df = spark.createDataFrame(rows, "g string, t double, v double")
    got = seq.number_rows(df, ["g"], ["t", "v"], limit=limit)
    want = df.withColumn("_i", F.row_number().over(Window.partitionBy("g").orderBy("t", "v")) - 1)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, map(tuple, want.collect())))
    _, keys, sizes, number = seq.cells(df, ["g"], ["t", "v"], limit)
    assert sizes.agg(F.sum("_cnt")).first()[0] == len(rows) and sizes.count() == number
    # a time with values that differ never stays one cell
    assert sizes.where("_k0 = 0 AND _k1 = 5.0").agg(F.max("_cnt")).first()[0] <= max(limit, 22)


def test_chunks_bring_every_neighbour(spark):
    from pyspark.sql import functions as F
    rnd = random.Random(9)
    rows = [("g", rnd.choice([float(k), float(k // 9 * 9)]), float(k)) for k in range(700)]
    df = spark.createDataFrame(rows, "g string, t double, v double")
    order = {(r[1], r[2]): i for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[2])))}
    h = seq.chunk_rows(df, ["g"], ["t", "v"], 64, ahead=20, behind=7).collect()
    assert all(order[r.t, r.v] == r._i for r in h)
    assert sorted(r._i for r in h if r._own) == list(range(700))
    for c in {r._c for r in h}:
        own = [r._i for r in h if r._c == c and r._own]
        have = {r._i for r in h if r._c == c}
        assert have >= set(range(max(0, own[0] - 7), own[0])) and have >= {i for i in range(max(own) + 1, max(own) + 21) if i < 700}
        assert len(have) < 64 * 3 and have == set(range(min(have), max(have) + 1))


def test_scan_of_a_group_with_equal_times(spark):
    """A group whose rows share few times is cut into chunks like any other."""
    rnd = random.Random(11)
    p = ScanParams.of(SCAN_BASIC)
    rows = [("g", float(k // 300), round(rnd.randint(0, 9) / 300.0, 9)) for k in range(1500)]
    df = spark.createDataFrame(rows, "recording_id string, ptp_time double, Yaw double")
    vals = [v for _, _, v in sorted(rows)]
    want = sorted(scan_loop(vals, p.minimum, p.maximum, p.lo, p.hi))
    for chunk in (200, 1 << 16):
        got = seq.yaw_return_scan(df, ["recording_id"], p, chunk=chunk).collect()
        assert sorted((r.i, r.j) for r in got) == want


def test_nan_positions_are_no_jumps(spark):
    nan = float("nan")
    df = spark.createDataFrame([("r", float(k), x, 0.0, 0.0) for k, x in enumerate([0.0, 1.0, nan, 100.0, 101.0, None, 5.0, 6.0, 60.0])],
                               "recording_id string, ptp_time double, PositionX double, PositionY double, PositionZ double")
    got = seq.position_stitch(df, ["recording_id"]).orderBy("ptp_time").collect()
    assert [r._jump for r in got] == [False] * 8 + [True]
    assert [r.PositionX for r in got][3:5] == [100.0, 101.0] and got[8].PositionX == 60.0 + 6.0 * 1.5 - 5.0 * 0.5
