"""Interval cover and range joins against all pairs."""

import math
import random

import pytest
from pyspark.sql import functions as F

from trajex.operators import filters as flt
from trajex.operators.cover import TOP, blocks, cover, levels_of
from trajex.operators.geometry import range_join

INF, NAN = math.inf, math.nan
ENDS = [(-INF, 5.0), (5.0, INF), (-INF, INF), (NAN, 5.0), (5.0, NAN), (None, 5.0), (5.0, None), (None, None), (9.0, 2.0), (3.0, 3.0),
        (-1e9, 1e9), (0.0, 1e-6), (59.999, 60.0), (60.0, 120.0), (-INF, -INF), (INF, INF)]


def inside(t, lo, hi):
    return None not in (t, lo, hi) and not any(map(math.isnan, (t, lo, hi))) and lo <= t <= hi


@pytest.mark.parametrize("broadcast", [True, False])
def test_intervals_equal_all_pairs(spark, broadcast):
    rnd = random.Random(2)
    starts = [rnd.uniform(-300, 300) for _ in range(60)]
    ends = ENDS + [(a, a + rnd.choice([0.5, 7, 61, 1000, 1e5])) for a in starts]
    iv = [(rnd.choice("ab"), k, lo, hi) for k, (lo, hi) in enumerate(ends)]
    ts = [(rnd.choice("ab"), t) for t in [None, NAN, INF, -INF, 0.0, 5.0, 60.0, -1e-9, 1e9] + [rnd.uniform(-400, 1500) for _ in range(200)]]
    got = flt.within_intervals(spark.createDataFrame(ts, "recording_id string, ptp_time double"),
                               spark.createDataFrame(iv, "recording_id string, id int, start_time double, end_time double"),
                               keep=("id",), broadcast=broadcast).collect()
    want = [(r, t, k) for r, t in ts for g, k, lo, hi in iv if r == g and inside(t, lo, hi)]
    assert sorted((r.recording_id, str(r.ptp_time), r.id) for r in got) == sorted((r, str(t), k) for r, t, k in want)


def test_an_interval_over_years_takes_two_rows(spark):
    df = spark.createDataFrame([(1.0e9 + 0.5, 1.4e9), (0.0, INF), (12.0, 13.0)], "lo double, hi double")
    c = cover(df, "lo", "hi", 60.0)
    assert c.count() <= 6 and c.groupBy("lo").count().agg(F.max("count")).first()[0] <= 2
    assert max(levels_of(c)) == TOP


def test_range_join_equals_all_pairs_and_empty_windows(spark):
    rnd = random.Random(4)
    pts = spark.createDataFrame([(rnd.choice("ab"), rnd.uniform(0, 500)) for _ in range(300)], "g string, t double")
    win = [(rnd.choice("ab"), a, a + rnd.choice([0.0, 12.0, 300.0])) for a in [rnd.uniform(0, 500) for _ in range(40)]]
    w = spark.createDataFrame(win, "g string, lo double, hi double")
    want = sum(p.g == g and lo <= p.t <= hi for p in pts.collect() for g, lo, hi in win)
    assert range_join(pts, w, ["g"], "t", "lo", "hi", 12.0).count() == want
    assert range_join(pts, w.where("false"), ["g"], "t", "lo", "hi", 12.0).count() == 0


@pytest.mark.parametrize("unit,cell_times", [(60.0, 256), (60.0, 3), (0.5, 256), (1000.0, 1)])
def test_interval_totals_equal_all_pairs(spark, unit, cell_times):
    rnd = random.Random(6)
    starts = [rnd.uniform(-300, 300) for _ in range(60)]
    ends = ENDS + [(1e30, INF), (-1e30, 1e30)] + [(a, a + rnd.choice([0.5, 7, 61, 1000, 1e5])) for a in starts]
    iv = [(rnd.choice(["a", "b", "a", "b", "c", None]), rnd.choice([k, k, k, 7, None]), lo, hi) for k, (lo, hi) in enumerate(ends)]
    times = [None, NAN, INF, -INF, 0.0, 5.0, 5.0, 60.0, -1e-9, 1e9, 2e30, -2e30] + [1e9] * 9 + [5.0] * 9
    ts = [(rnd.choice(["a", "b", "b", None]), t) for t in times + [rnd.uniform(-400, 1500) for _ in range(200)]
          + [3.0 + k * 1e-7 for k in range(40)]]
    got = flt.interval_totals(spark.createDataFrame(ts, "recording_id string, ptp_time double"),
                              spark.createDataFrame(iv, "recording_id string, id int, start_time double, end_time double"),
                              keep=("id",), bucket_seconds=unit, cell_times=cell_times)
    pairs = {}
    for r, t in ts:
        for g, k, lo, hi in iv:
            if r is not None and r == g and inside(t, lo, hi):
                pairs.setdefault((r, k), []).append(t)
    assert got.columns == ["recording_id", "id", "n", "first", "last"]
    assert {(r.recording_id, r.id): (r.n, r.first, r.last) for r in got.collect()} == {k: (len(v), min(v), max(v)) for k, v in pairs.items()}
    assert got.count() == len(pairs)


def test_blocks_make_up_each_run_once(spark):
    runs = [(a, a + n) for a in (-9, -8, -1, 0, 1, 5, 16, 2**61 - 70) for n in (-2, 0, 1, 2, 7, 16, 61)]
    got = {}
    for r in blocks(spark.createDataFrame(runs, "a long, z long"), "a", "z").collect():
        got.setdefault((r.a, r.z), []).append((r._lv, r._b))
    for a, z in runs:
        cells = [c for lv, b in got.get((a, z), []) for c in range(b << lv, (b + 1) << lv)]
        assert sorted(cells) == list(range(a, z)), (a, z)
        assert len(got.get((a, z), [])) <= 2 * max(z - a, 1).bit_length()


def test_interval_ends_pairs_grow_with_rows_not_rows_times_intervals(spark, tmp_path, monkeypatch):
    from trajex.plans.queries import Q
    # one recording of 12,000 rows; about 40 of its 100 intervals hold most of it
    (spark.range(12000).selectExpr("id as o_orderkey", "id * 20 as o_custkey").write.parquet(str(tmp_path / "orders.parquet")))
    (spark.range(2000).selectExpr("id as s_suppkey").write.parquet(str(tmp_path / "supplier.parquet")))
    within, paired = flt.within_intervals, []

    def spy(*args, **kw):
        paired.append(within(*args, **kw))
        return paired[-1]

    monkeypatch.setattr(flt, "within_intervals", spy)
    got = {(r.recording_id, r.id): (r.n, r.first, r.last) for r in Q["interval_ends"](spark, str(tmp_path)).collect()}
    assert sum(df.count() for df in paired) < 12000
    want = {}
    for s in range(0, 2000, 20):
        lo = {0: -INF, 1: NAN, 2: NAN, 3: -1e8}.get(s % 9, s * 3.0)
        hi = {4: INF, 5: NAN, 6: NAN, 7: s * 3.0 - 5, 3: 1e8}.get(s % 9, s * 3.0 + 7)
        inner = [k / 8 for k in range(12000) if inside(k / 8, lo, hi)]
        if inner:
            want["FH2000_20220310_00", s] = (len(inner), inner[0], inner[-1])
    assert got == want and sum(n for n, _, _ in want.values()) > 200_000
