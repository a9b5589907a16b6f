import math
import random

import pytest
from helpers import overlap_loop
from pyspark.sql import Row

from trajex.operators import filters as flt
from trajex.operators import labels as lab
from trajex.operators import stats as sts
from trajex.operators import tags as tg
from trajex.plans import queries as qm
from trajex.plans import scenario as scn


def test_overlay_keeps_row_count_and_priority(spark, sf_small):
    inp = qm.scene_inputs(spark, sf_small)
    out = scn.scenario_labels(inp)
    _, objects, _ = scn.prepared(inp)
    assert out.count() == objects.count() == 1297
    naive = sorted(map(tuple, lab.label_counts(scn.scenario_labels_naive(inp)).collect()))
    assert sorted(map(tuple, lab.label_counts(out).collect())) == naive


def test_combine_status_custom_priority(spark):
    obj = spark.createDataFrame([Row(ptp_time=0.1, recording_id="r", v=1)])
    a = spark.createDataFrame([Row(ptp_time=0.1, recording_id="r", status=7)])
    b = spark.createDataFrame([Row(ptp_time=0.1, recording_id="r", status=5)])
    assert lab.combine_status(obj, a, b).first().status == 7
    assert lab.combine_status(obj, a, b, priority={7: 1, 5: 2}).first().status == 5


def test_nan_steering_counts_as_turning(spark):
    st = spark.createDataFrame([Row(ptp_time=0.1, recording_id="r", LaneChangeStatus=0,
                                    SteeringWheelAngle=float("nan"), VehicleDirSAE_VehSpeed=70.0)])
    assert lab.label_turning(st).count() == 1


@pytest.mark.parametrize("chunk", [tg.CHUNK_ROWS, 3])
def test_tag_overlap_matches_loop(spark, chunk):
    rnd = random.Random(11)
    rows = []
    for rec in ("a", "b"):
        for k in range(60):
            s = rnd.randint(0, 400)
            rows.append(Row(recording_id=rec, tag=rnd.choice(["click", "view", "error", "x"]),
                            start_time=s, end_time=s + rnd.randint(0, 60), tag_id=len(rows)))
    df = spark.createDataFrame(rows)
    got = sorted((r.recording_id, r.start_time, r.end_time)
                 for r in tg.tag_overlap(df, ["click", "view"], ["error"], chunk=chunk).collect())
    want = []
    for rec in ("a", "b"):
        want += [(rec, float(a), float(b)) for a, b in overlap_loop(
            [(r.tag, r.start_time, r.end_time) for r in rows if r.recording_id == rec],
            ["click", "view"], ["error"])]
    assert got == sorted(want)


def test_quantile_rank_error(spark, sf_small):
    from trajex.sources import fixtures as fx
    tr = fx.track(spark, sf_small)
    vals = sorted(r.Yaw for r in tr.select("Yaw").collect())
    q = sts.signal_quantiles(tr, "Yaw", probs=(0.25, 0.75), rel_error=0.01).first()
    n = len(vals)
    for p, v in ((0.25, q.q25), (0.75, q.q75)):
        lo = sum(x < v for x in vals)
        hi = sum(x <= v for x in vals)
        assert lo - 0.01 * n <= p * n <= hi + 0.01 * n


def test_drop_constant_columns_like_nunique(spark):
    # b: one value; n: all null (0 distinct, kept); z: all NaN (0 distinct,
    # kept); y: one value besides NaN (1 distinct, dropped)
    df = spark.createDataFrame([(1.0, "c", None, float("nan"), 3.0), (2.0, "c", None, float("nan"), float("nan"))],
                               "a double, b string, n double, z double, y double")
    assert flt.drop_constant_columns(df).columns == ["a", "n", "z"]


def test_recorded_hours_and_median_skip_nan(spark):
    meta = spark.createDataFrame([(0.0, 10.0, "f"), (float("nan"), 5.0, "f"), (1.0, 2.0, ""), (1.0, 4.0, None)],
                                 "first_ptp_time double, last_ptp_time double, filename_parquet string")
    assert sts.recorded_hours(meta).first().total_seconds == 10.0
    df = spark.createDataFrame([(1.0,), (float("nan"),), (3.0,), (None,), (2.0,)], "x double")
    assert df.select(sts.exact_median(df, "x").alias("m")).first().m == 2.0


def test_density_integrates_to_one(spark):
    rows = [Row(v=math.sin(k) * 0.01) for k in range(500)]
    d = sts.signal_density(spark.createDataFrame(rows), "v").orderBy("g").collect()
    step = d[1].x - d[0].x
    assert abs(sum(r.density for r in d) * step - 1.0) < 0.02


def test_interval_join_strategies_agree(spark, sf_small):
    from trajex.sources import fixtures as fx
    e, iv = fx.ego(spark, sf_small), fx.intervals(spark, sf_small)
    a = flt.within_intervals(e, iv)
    b = flt.within_intervals(e, iv, broadcast_max_rows=0, bucket_seconds=3.0)
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_country_split_missing_country_is_europe(spark):
    df = spark.createDataFrame([("Japan",), ("Brazil",), ("no country",), (None,), ("Sweden",)], "country string")
    eu, jp, br = flt.country_split(df)
    assert sorted(r.country or "" for r in eu.collect()) == ["", "Sweden"]
    assert jp.count() == 1 and br.count() == 1
    groups = {r.country: r.country_group for r in flt.country_group(df).collect()}
    assert groups[None] == "europe" and groups["no country"] is None


def test_tag_filter_names_and_recordings(spark):
    df = spark.createDataFrame([("1", "click"), ("1", "view"), ("2", "click"), ("3", "error")],
                               "recording_id string, tag string")
    assert tg.tag_filter(df, ["click"]).count() == 2
    assert tg.tag_filter(df, recordings=["1"]).count() == 2
    assert tg.tag_filter(df, ["click"], ["1"]).count() == 1
    assert tg.tag_filter(df).count() == 4
    big = [str(k) for k in range(2000)]          # beyond the isin limit: a semi join
    assert tg.tag_filter(df, ["click"], big).count() == 2


def test_time_slice_one_recording(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 5.0), ("b", 2.0)], "recording_id string, ptp_time double")
    assert flt.time_slice(df, 1.0, 2.0, recording_id="a").count() == 1
    assert flt.road_type_filter(spark.createDataFrame(
        [("a", "[Road, Type, Motorway]"), ("b", "[Road, Type, Motorway]"), ("a", "x")],
        "recording_id string, tag_name_list string"), recording_id="a").count() == 1


@pytest.mark.parametrize("broadcast", [True, False])
def test_interval_ends_inclusive_and_overlaps_repeat(spark, broadcast):
    rows = spark.createDataFrame([("r", t) for t in (0.5, 1.0, 1.5, 2.0, 2.5, 3599.9, 3600.0, 7300.0)],
                                 "recording_id string, ptp_time double")
    iv = spark.createDataFrame([("r", 1.0, 2.0), ("r", 1.5, 3600.0), ("q", 0.0, 9.0), ("r", 3600.0, 7300.0)],
                               "recording_id string, start_time double, end_time double")
    got = sorted(r.ptp_time for r in flt.within_intervals(rows, iv, broadcast=broadcast,
                                                          bucket_seconds=1.0).collect())
    assert got == [1.0, 1.5, 1.5, 2.0, 2.0, 2.5, 3599.9, 3600.0, 3600.0, 7300.0]


def test_interval_list_explode_text_forms(spark):
    from trajex.sources import intervals as ivs

    def read(cells):
        df = spark.createDataFrame(cells, "recording_id string, intervals string")
        return sorted(tuple(r) for r in ivs.explode_interval_list(df).collect())

    got = read([("a", "[[1.5, 2.0],[3, 4.25]]"), ("b", "[]"), ("c", None), ("d", " "), ("e", "[(1.0, 2.0), (3.0, 4.0),]")])
    assert got == [("a", 0, 1.5, 2.0), ("a", 1, 3.0, 4.25), ("e", 0, 1.0, 2.0), ("e", 1, 3.0, 4.0)]
    for cell in ("not a list", "[[1,2", "[[1]]"):
        with pytest.raises(Exception, match="not a list of intervals"):
            read([("x", cell)])


@pytest.mark.parametrize("chunk", [2, 65536])
def test_tag_overlap_open_and_inverted_ends(spark, chunk):
    from trajex.operators import tags as tg
    rows = [("r", "a", 0.0, 10.0), ("r", "b", 2.0, 8.0), ("r", "a", 20.0, None), ("r", "a", None, 99.0),
            ("r", "a", 15.0, 15.0), ("r", "a", 18.0, 12.0), (None, "a", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "recording_id string, tag string, start_time double, end_time double")
    got = sorted(map(tuple, tg.tag_overlap(df, ["a"], ["b"], chunk=chunk).collect()), key=str)
    assert got == sorted([("r", 0.0, 2.0), ("r", 8.0, 10.0), ("r", 20.0, None), (None, 1.0, 2.0)], key=str)


def test_tag_query_text():
    from trajex.operators.tags import overlap_terms
    assert overlap_terms("'A' and 'B'") == (["A", "B"], [])
    assert overlap_terms("'A' AND not 'B and C' and 'D'") == (["A", "D"], ["B and C"])
    for bad in ("A and B", "'A' or 'B'", "'A' and", ""):
        with pytest.raises(ValueError):
            overlap_terms(bad)


def test_tag_filter_keeps_columns_and_types(spark):
    from trajex.operators import tags as tg
    df = spark.createDataFrame([("r", "a", "t", "s"), ("q", "b", "u", "s")], "recording_id string, tag string, type string, sub_type string")
    many = ["a"] + [f"n{k}" for k in range(tg.ISIN_MAX)]
    assert tg.tag_filter(df, many).columns == df.columns
    assert [r.recording_id for r in tg.tag_filter(df, many).collect()] == ["r"]
    assert [r.tag for r in tg.tag_filter(df, types=["u"], sub_types=["s"]).collect()] == ["b"]


def test_exact_median_of_hot_values_has_no_unpartitioned_window(spark):
    rnd = random.Random(1)
    cases = {"hot": [5.0] * 900 + [rnd.random() * 10 for _ in range(101)], "split": [1.0] * 50 + [2.0] * 50,
             "spread": [rnd.random() for _ in range(1000)], "one": [3.0]}
    for vals in cases.values():
        df = spark.createDataFrame([(v,) for v in vals], "x double")
        for accuracy in (100_000, 20):
            got = spark.range(1).select(sts.exact_median(df, "x", accuracy=accuracy, parts=7).alias("m"))
            vals = sorted(vals)
            assert got.first().m == (vals[(len(vals) - 1) // 2] + vals[len(vals) // 2]) / 2
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange SinglePartition, ENSURE_REQUIREMENTS" in plan
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert windows and all("part#" in line.split("],")[1] for line in windows)


def test_density_equals_the_direct_sum(spark):
    vals = [0.0, 0.0, 1.0, 2.5, 4.0, 4.0, 4.0, None, float("nan")]
    d = sts.signal_density(spark.createDataFrame([(v,) for v in vals], "v double"), "v", gridsize=33).orderBy("g").collect()
    x = [v for v in vals if v is not None and not math.isnan(v)]
    mean = sum(x) / len(x)
    bw = math.sqrt(sum((v - mean) ** 2 for v in x) / (len(x) - 1)) * len(x) ** -0.2
    assert [r.g for r in d] == list(range(33))
    for r in d:
        want = sum(math.exp(-0.5 * ((r.x - v) / bw) ** 2) for v in x) / (len(x) * bw * math.sqrt(2 * math.pi))
        assert abs(r.density - want) < 1e-9


def test_tag_pages_by_key_cover_all_rows(spark):
    rows = [Row(a=k // 3, b=k % 3) for k in range(20)]
    tags, last, got = spark.createDataFrame(rows), (), []
    while page := tg.tag_page_after(tags, last, 6, ("a", "b")).collect():
        got += page
        last = tuple(page[-1])
    assert got == rows


def test_speed_attach_repeats_rows_per_status_row(spark, sf_small):
    inp = qm.scene_inputs(spark, sf_small)
    with_speed = scn.scenario_labels(inp, attach_speed=True)
    want = lab.speed_attach(scn.scenario_labels(inp), scn.prepared(inp)[2].drop("_tk"))
    cols = sorted(want.columns)
    assert sorted(map(repr, with_speed.select(cols).collect())) == sorted(map(repr, want.select(cols).collect()))
