from pyspark.sql import Row

from trajex.operators import tables as tb

SCHEMA = "rid string, name string, v double"


def _table(spark):
    return spark.createDataFrame([("a", None, 1.0), ("a", "x", 2.0), ("b", "", 3.0), ("c", "y", 4.0)], SCHEMA)


def test_lookup_repeats_and_matches_null(spark):
    keys = spark.createDataFrame([("a", None), ("a", None), ("b", "")], "rid string, name string")
    got = sorted(r.v for r in tb.key_lookup(_table(spark), keys, ["rid", "name"]).collect())
    assert got == [1.0, 1.0, 3.0]


def test_lookup_empty_keeps_schema(spark):
    keys = spark.createDataFrame([("zz", "q")], "rid string, name string")
    out = tb.key_lookup(_table(spark), keys, ["rid", "name"])
    assert out.count() == 0 and out.columns == ["rid", "name", "v"]


def test_exists_in_key_order(spark):
    keys = spark.createDataFrame([(0, "a"), (1, "q"), (2, "c")], "k int, rid string")
    got = sorted((r.k, r.exists) for r in tb.key_exists(_table(spark), keys, ["rid"]).collect())
    assert got == [(0, True), (1, False), (2, True)]


def test_replace_inserts_without_match(spark):
    new = spark.createDataFrame([("a", "n", 9.0), ("zz", "m", 8.0)], SCHEMA)
    keys = spark.createDataFrame([Row(rid="a"), Row(rid="q")])
    out = tb.replace_rows(_table(spark), new, keys, ["rid"], date_col="d", when="2024/01/01_00:00:00")
    got = sorted((r.rid, r.v, r.d) for r in out.collect())
    assert got == [("a", 9.0, "2024/01/01_00:00:00"), ("b", 3.0, None), ("c", 4.0, None),
                   ("zz", 8.0, "2024/01/01_00:00:00")]


def test_update_keeps_row_count(spark):
    keys = spark.createDataFrame([Row(rid="a"), Row(rid="a")])
    out = tb.update_by_key(_table(spark), {"v": 0.0}, keys, ["rid"])
    assert sorted(r.v for r in out.collect()) == [0.0, 0.0, 3.0, 4.0]


def test_write_append_history_and_outer_union(spark):
    path = tb.scratch_path(spark, "t")
    tb.write_table(_table(spark), path, append=False, date_col="write_to_db_date",
                   when="2024/01/01_00:00:00", history=True)
    tb.write_table(_table(spark), path, history=True)
    assert spark.read.parquet(path).count() == 8
    assert spark.read.parquet(path + "_history").count() == 8
    u = tb.outer_union(_table(spark), spark.createDataFrame([("d", 1)], "rid string, extra int"))
    assert u.count() == 5 and "extra" in u.columns


def test_scan_one_recording_prunes_partitions(spark, sf_small):
    from trajex.sources import fixtures as fx
    from trajex.sources import recordings as rc
    root = tb.scratch_path(spark, "streams")
    rc.write_recordings(fx.track(spark, sf_small), root, "reference", "ego")
    one = rc.scan_recording(spark, root, "reference", "ego", recording_id="FH2003_20220313_00")
    assert one.count() == fx.track(spark, sf_small).where("recording_id = 'FH2003_20220313_00'").count()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(recording_id" in plan


def test_time_slice_pushes_to_the_scan(spark, sf_small):
    from trajex.operators import filters as flt
    from trajex.sources import fixtures as fx
    from trajex.sources import recordings as rc
    root = tb.scratch_path(spark, "streams")
    rc.write_recordings(fx.track(spark, sf_small), root, "reference", "ego")
    df = flt.time_slice(rc.scan_recording(spark, root, "reference", "ego"), 100.0, 900.0,
                        recording_id="FH2003_20220313_00").select("ptp_time", "Yaw")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(recording_id" in plan
    assert "GreaterThanOrEqual(ptp_time,100.0)" in plan and "LessThanOrEqual(ptp_time,900.0)" in plan
    assert "ReadSchema: struct<ptp_time:double,Yaw:double>" in plan


def test_interval_join_prunes_recordings_dynamically(spark, sf_small):
    from trajex.operators import filters as flt
    from trajex.sources import fixtures as fx
    from trajex.sources import recordings as rc
    root = tb.scratch_path(spark, "streams")
    rc.write_recordings(fx.track(spark, sf_small), root, "reference", "ego")
    iv = fx.track_intervals(spark, sf_small).where("id < 3")
    df = flt.within_intervals(rc.scan_recording(spark, root, "reference", "ego"), iv)
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString()
    assert df.count() == flt.within_intervals(fx.track(spark, sf_small), iv).count()


def test_replace_rows_on_a_stored_table_writes_beside(spark):
    path = tb.scratch_path(spark, "meta")
    _table(spark).write.parquet(path)
    table = tb.read_table(spark, path)
    new = spark.createDataFrame([("a", "n", 9.0)], SCHEMA)
    keys = spark.createDataFrame([Row(rid="a")])
    out = tb.write_beside(tb.replace_rows(table, new, keys, ["rid"]), path)
    assert out != path
    got = sorted((r.rid, r.v) for r in spark.read.parquet(out).collect())
    assert got == [("a", 9.0), ("b", 3.0), ("c", 4.0)]
    assert spark.read.parquet(path).count() == 4      # the input is untouched


def test_key_exists_beyond_the_broadcast_bound(spark, monkeypatch):
    keys = spark.createDataFrame([(0, "a", None), (1, "a", None), (2, "zz", "q"), (3, None, None)], "k int, rid string, name string")
    want = [(0, True), (1, True), (2, False), (3, False)]
    for bound in (tb.KEY_BROADCAST_MAX_ROWS, 1):
        monkeypatch.setattr(tb, "KEY_BROADCAST_MAX_ROWS", bound)
        got = tb.key_exists(_table(spark), keys, ["rid", "name"])
        assert sorted((r.k, r.exists) for r in got.collect()) == want


def test_clear_intermediates(spark):
    import os

    from trajex.session import clear_intermediates, materialize
    kept = materialize(_table(spark), "kept")
    path = kept.inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path)
    assert clear_intermediates(spark) >= 1
    assert not os.path.exists(path) and clear_intermediates(spark) == 0
