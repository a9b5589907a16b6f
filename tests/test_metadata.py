import os
import tempfile

from pyspark.sql import Row

from trajex.operators import metadata as md


def _parse(spark, path, lines):
    df = spark.createDataFrame([Row(path=path, line_no=k, line=l) for k, l in enumerate(lines)])
    return md.parse_annotations(df).first().asDict()


def test_rule_order_and_later_lines_win(spark):
    r = _parse(spark, "/d/FH1_20220301/annot/a.txt", [
        "MOIS", "10:00:01: recording has started", "target from right", "bike on left side",
        "pedestrian center", "speed 20 kph: 20", "result: ok", "result: nok",
        "10:09:00: recording has stopped"])
    assert r["recording_id"] == "FH1_20220301_00"
    assert r["test_function"] == "MOIS" and r["test_activity"] == "JPT4"
    assert r["start_recording"] == "10:00:01" and r["stop_recording"] == "10:09:00"
    # 'pedestrian center': bike, pedestrian, then the center rule sets bike
    # last; the later kph line sets the scenario to crossing
    assert r["target_type"] == "bike" and r["scenario"] == "crossing"
    assert r["side"] == "center" and r["target_speed"] == "20"
    assert r["pass/fail"] == "ok, nok"
    assert r["full_annotation"].startswith("MOIS 10:00:01: recording has started target")


def test_non_mois_only_generic_rules(spark):
    r = _parse(spark, "/d/FH2_20220302/annot/b.txt", ["AEBS", "target from right", "result: ok"])
    assert r["side"] is None and r["scenario"] is None and r["pass/fail"] == "ok"


def test_ped_without_stopped_is_pedestrian(spark):
    r = _parse(spark, "/d/FH4_20220304/annot/d.txt", ["MOIS", "ped crossing", "ped stopped"])
    assert r["target_type"] == "pedestrian"


def test_line_without_colon_gives_no_value(spark):
    r = _parse(spark, "/d/FH3_20220303/annot/c.txt", ["MOIS", "looks ok", "speed kph"])
    assert r["pass/fail"] is None and r["target_speed"] is None and r["scenario"] == "crossing"


def test_read_text_files_keep_newlines(spark):
    root = tempfile.mkdtemp(prefix="annot-", dir="/tmp")
    d = os.path.join(root, "FH2467_20220328", "annot")
    os.makedirs(d)
    with open(os.path.join(d, "x.txt"), "w") as f:
        f.write("MOIS\n10:00:01: recording has started\nresult: ok\nfollow bike\n")
    lines = md.read_annotation_lines(spark, os.path.join(root, "*", "annot", "*.txt"))
    assert lines.count() == 4
    r = md.parse_annotations(lines).first()
    assert r.recording_id == "FH2467_20220328_00"
    assert r.start_recording == "10:00:01" and r["pass/fail"] == "ok"
    assert r.full_annotation == "MOIS\n 10:00:01: recording has started\n result: ok\n follow bike\n"
    built = md.metadata_build(md.parse_annotations(lines)).first()
    assert built.vehicle_id == "FH2467" and str(built.test_date) == "2022-03-28"


def test_folders_line_ends_and_empty_values(spark, tmp_path):
    deep = tmp_path / "FH7_20220307" / "annot"
    deep.mkdir(parents=True)
    (deep / "a.txt").write_bytes(b"MOIS\r\nok:\r\nfollow bike\r\n")
    (deep / "a.csv").write_bytes(b"no annotation\n")
    r = md.parse_annotations(md.read_annotation_lines(spark, str(tmp_path))).collect()
    assert len(r) == 1 and r[0]["pass/fail"] == ""
    assert r[0].full_annotation == "MOIS\n ok:\n follow bike\n"


def test_bad_ids_give_nulls(spark):
    df = spark.createDataFrame([("bad",), ("FH1_x_00",), ("FH1_20220301_00",)], "recording_id string")
    got = {r.recording_id: (r.vehicle_id, str(r.test_date)) for r in md.recording_id_parts(df).collect()}
    assert got == {"bad": ("bad", "None"), "FH1_x_00": ("FH1", "None"), "FH1_20220301_00": ("FH1", "2022-03-01")}
    paths = spark.createDataFrame([("a.txt",), ("/x/FH1_20220301/annot/a.txt",)], "p string")
    assert [r[0] for r in paths.select(md.path_recording_id(paths.p)).collect()] == [None, "FH1_20220301_00"]
