"""Stored tables: scoped rewriting, ranked pages, sketches, JSON columns, the
object store, annotation files in splits."""

import math
import os
import random

import pytest
from pyspark.sql import functions as F

from trajex.operators import metadata as md
from trajex.operators import stats as sts
from trajex.operators import tables as tb
from trajex.operators import tags as tg
from trajex.plans import queries as qm
from trajex.plans import scenario as scn


def files(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture
def store(spark, tmp_path):
    df = spark.createDataFrame([(f"r{k % 5}", k, f"v{k}") for k in range(50)] + [(None, 50, "v50")], "rec string, id long, v string")
    tb.write_partitioned(df, str(tmp_path / "t"), ["rec"])
    return str(tmp_path / "t")


def test_only_partitions_with_a_key_are_rewritten(spark, store):
    before = files(store)
    keys = spark.createDataFrame([(7,), (12,)], "id long")  # both in r2
    assert tb.update_in_store(spark, store, ["rec"], {"v": "new"}, keys, ["id"]) == 1
    assert {f for f in before if "rec=r2" not in f} == {f for f in files(store) if "rec=r2" not in f}
    rows = {r.id: (r.rec, r.v) for r in spark.read.parquet(store).collect()}
    assert len(rows) == 51 and rows[7] == ("r2", "new") and rows[12] == ("r2", "new") and rows[2] == ("r2", "v2") and rows[50] == (None, "v50")


def test_replace_adds_partitions_and_drops_empty_ones(spark, store):
    keys = spark.createDataFrame([("r1",), (None,)], "rec string")
    new = spark.createDataFrame([("r9", 900, "a"), ("r2", 901, "b")], "rec string, id long, v string")
    assert tb.replace_in_store(spark, store, ["rec"], new, keys, ["rec"]) == 4
    rows = spark.read.parquet(store).collect()
    assert {r.rec for r in rows} == {"r0", "r2", "r3", "r4", "r9"} and len(rows) == 42
    assert not any("rec=r1" in f for f in files(store))


def test_folders_keep_their_names(spark, tmp_path):
    path = str(tmp_path / "t")
    tb.write_partitioned(spark.createDataFrame([("01", 1, "a"), ("1", 2, "b"), ("2", 3, "c")], "rec string, id long, v string"), path, ["rec"])
    tb.update_in_store(spark, path, ["rec"], {"v": "new"}, spark.createDataFrame([(1,)], "id long"), ["id"])
    rows = spark.read.schema("id long, v string, rec string").parquet(path).collect()
    assert sorted((r.rec, r.id, r.v) for r in rows) == [("01", 1, "new"), ("1", 2, "b"), ("2", 3, "c")]


def test_a_failed_rewrite_leaves_the_old_version(spark, store):
    before = files(store)
    with pytest.raises(Exception, match="stop here"):
        tb.rewrite_partitions(spark, store, ["rec"], spark.createDataFrame([(7,)], "id long"), ["id"],
                              lambda d: d.withColumn("v", F.when(F.col("id") == 7, F.raise_error(F.lit("stop here"))).otherwise(F.col("v"))))
    assert files(store) == before and spark.read.parquet(store).count() == 51
    with pytest.raises(ValueError, match="cannot be updated"):
        tb.update_in_store(spark, store, ["rec"], {"rec": "x"}, spark.createDataFrame([(7,)], "id long"), ["id"])


def test_swap_puts_a_new_version_in_place(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    new = tb.write_beside(spark.range(5), path)
    old = tb.swap(spark, path, new)
    assert spark.read.parquet(path).count() == 5 and spark.read.parquet(old).count() == 3
    with pytest.raises(OSError, match="cannot rename"):
        tb.swap(spark, path, str(tmp_path / "missing"))
    assert spark.read.parquet(path).count() == 5


def test_keys_from_the_table_itself(spark):
    t = spark.createDataFrame([("a", 1), ("b", None), (None, 3)], "k string, n int")
    assert all(r.exists for r in tb.key_exists(t, t.where("n is null or n = 3"), ["k", "n"]).collect())
    got = tb.update_by_key(t, {"n": 9}, t.where("k is null"), ["k"]).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, [("a", 1), ("b", None), (None, 9)]))


def test_ranked_pages_cover_every_row_once(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(k, rnd.choice([None, 1.0, 2.5, 7.0, float(rnd.randint(0, 50))])) for k in range(500)]
    df = spark.createDataFrame(rows, "tag_id long, w double")
    path = str(tmp_path / "ranked")
    tg.write_ranked(df, path, ("w", "tag_id"), ranges=9)
    want = [tuple(r) for r in df.orderBy("w", "tag_id").collect()]
    got = []
    for offset in range(0, 560, 70):
        page = tg.ranked_page(spark, path, offset, 70)
        got += [tuple(r) for r in page.collect()]
    assert got == want
    # a deep page reads as few ranges as the first: the others are pruned by their folders
    for offset in (0, 400):
        plan = tg.ranked_page(spark, path, offset, 20)._jdf.queryExecution().executedPlan().toString()
        wanted = plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
        assert "_range" in wanted and wanted.count(",") <= 3


def test_pages_by_key_go_on_after_nulls(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (None, 3), (1.0, 4), (1.0, 5), (2.0, 6)], "w double, tag_id int")
    got, last = [], ()
    while page := tg.tag_page_after(df, last, 2, ("w", "tag_id")).collect():
        got += [r.tag_id for r in page]
        last = tuple(page[-1])
    assert got == [1, 2, 3, 4, 5, 6]


def test_a_name_in_both_lists_never_holds(spark):
    t = spark.createDataFrame([("r", "A", 0.0, 10.0), ("r", "B", 2.0, 4.0)], "recording_id string, tag string, start_time double, end_time double")
    assert tg.tag_overlap_query(t, "'A' and not 'A'").count() == 0
    assert [(r.start_time, r.end_time) for r in tg.tag_overlap_query(t, "'A' and not 'B'").orderBy("start_time").collect()] == [(0.0, 2.0), (4.0, 10.0)]


def test_json_columns_are_found(spark):
    items = ['{"a":1,"b":{"c":"x","d e":2.5}}', '{"b":{"c":null,"f":{"g":true}},"l":[{"z":1},{"z":2}]}', None, "{}", "no json", '{"a":7000000000,"v":null}']
    flat = tg.json_flatten(spark.createDataFrame([(k, s) for k, s in enumerate(items)], "id int, j string"), "j")
    assert set(flat.columns) == {"id", "a", "b.c", "b.d e", "b.f.g", "l", "v"}
    rows = {r["id"]: r for r in flat.collect()}
    assert rows[0]["b.c"] == "x" and rows[0]["b.d e"] == 2.5 and rows[5]["a"] == 7000000000 and rows[1]["b.f.g"] is True
    assert [x["z"] for x in rows[1]["l"]] == [1, 2] and rows[4]["a"] is None and rows[3]["l"] is None
    empty = tg.json_flatten(spark.createDataFrame([], "id int, j string"), "j")
    assert empty.columns == ["id", "j"]


def test_sketches_merge(spark):
    rnd = random.Random(3)
    vals = [(f"r{k % 7}", rnd.gauss(0, 1) if k % 50 else math.nan) for k in range(20000)] + [("r1", None)]
    df = spark.createDataFrame(vals, "recording_id string, v double").repartition(6)
    merged = sts.merged_quantiles(sts.signal_sketches(df, ["v"], ["recording_id"]), (0.25, 0.5, 0.99)).first()
    kept = sorted(v for _, v in vals if v is not None and not math.isnan(v))
    assert merged["n"] == len(kept) and merged["least"] == kept[0] and merged["greatest"] == kept[-1]
    for name, p in (("q25", 0.25), ("q50", 0.5), ("q99", 0.99)):
        rank = sum(v <= merged[name] for v in kept) / len(kept)
        assert abs(rank - p) < 0.02
    assert abs(merged["n_distinct"] - len(set(kept))) < 0.05 * len(kept)


def test_statistics_leave_out_nan_and_null(spark):
    nan = math.nan
    df = spark.createDataFrame([(v,) for v in (nan, 1.0, 2.0, nan, 3.0, None)], "v double")
    assert tuple(sts.signal_quantiles(df, "v").first()) == (1.0, 3.0)
    assert tuple(sts.signal_extent(df, ["v"]).first()) == (3.0, 1.0)
    assert sts.distinct_counts(df, ["v"]).first()[0] == 3
    assert sorted((r.bin, r["count"]) for r in sts.signal_histogram(df, "v", 2).collect()) == [(0, 1), (1, 2)]
    geo = spark.createDataFrame([(1.0, 2.0), (nan, 2.0), (1.0, None)], "etrs89_latitude double, etrs89_longitude double")
    assert [tuple(r) for r in sts.geo_density(geo, 1.0).collect()] == [(1, 2, 1)]


def test_density_of_constant_and_of_far_values(spark):
    assert sts.signal_density(spark.createDataFrame([(2.0,)] * 9, "v double"), "v").count() == 0
    assert sts.signal_density(spark.createDataFrame([(2.0,)], "v double"), "v").count() == 0
    assert sts.signal_density(spark.createDataFrame([], "v double"), "v").count() == 0
    rnd = random.Random(5)
    vals = [rnd.gauss(0, 0.001) for _ in range(200)] + [500.0]  # most of the grid is beyond reach of any value
    got = {r.g: (r.x, r.density) for r in sts.signal_density(spark.createDataFrame([(v,) for v in vals], "v double"), "v").collect()}
    n = len(vals)
    mean = sum(vals) / n
    bw = math.sqrt(sum((v - mean) ** 2 for v in vals) / (n - 1)) * n ** -0.2
    assert len(got) == 200
    for x, density in got.values():
        want = sum(math.exp(-0.5 * ((x - v) / bw) ** 2) for v in vals) / math.sqrt(2 * math.pi) / (bw * n)
        assert abs(density - want) < 1e-12


def test_stored_objects_do_not_move(spark, sf_small, tmp_path):
    inp = qm.scene_inputs(spark, sf_small)
    scn.write_object_store(inp.objects, "objects_plan", 8, str(tmp_path / "objects"))
    try:
        out = scn.scenario_labels(scn.SceneInputs(inp.ego, scn.object_store(spark, "objects_plan"), inp.status, inp.intervals, stored=True))
        plan = out._jdf.queryExecution().executedPlan().toString()
        # walk down from each scan of the stored objects: no exchange above it but below the first join of the other sides
        depth = {}
        above = []
        for line in plan.split("\n"):
            indent = len(line) - len(line.lstrip(" :+-*()0123456789"))
            while above and above[-1][0] >= indent:
                above.pop()
            above.append((indent, line.strip(" :+-")))
            if "FileScan parquet" in line and "objects_plan" in line:
                depth["exchanges"] = sum(" Exchange " in f" {x} " or x.startswith("Exchange") for _, x in above)
        assert depth == {"exchanges": 0}, plan
        same = scn.scenario_labels(inp)
        assert sorted(map(str, out.collect())) == sorted(map(str, same.select(out.columns).collect()))
    finally:
        spark.sql("DROP TABLE objects_plan")


def test_annotation_files_are_read_in_splits(spark, tmp_path):
    d = tmp_path / "FH1_20220301" / "annot"
    d.mkdir(parents=True)
    lines = ["MOIS"] + [f"note {k}: x{k}" for k in range(4000)] + ["result: ok", "bike on left side", "speed 20 kph: 31", "speed 20 kph: 32"]
    (d / "big.txt").write_text("\n".join(lines))
    (d / "small.txt").write_text("AEBS\nresult: nok\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        read = md.read_annotation_lines(spark, str(tmp_path))
        assert read.rdd.getNumPartitions() > 5
        got = {r.annotation_filename.rsplit("/", 1)[1]: r for r in md.parse_annotations(read).collect()}
        slim = md.parse_annotations(read, full_text=False)
        assert "full_annotation" not in slim.columns and slim.count() == 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    big = got["big.txt"]
    assert big.full_annotation == " ".join(x + "\n" for x in lines)
    assert (big.test_function, big.target_speed, big.side, big["pass/fail"]) == ("MOIS", "32", "left", "ok")
    assert got["small.txt"].test_function == "AEBS"
