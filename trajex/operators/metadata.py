"""Annotation metadata.

Annotation files become (path, line_no, line) rows; every rule below turns
a line into (field, value, line_no, rule_no) candidates and one aggregation
per file keeps, per field, the candidate of the latest line and, within a
line, the latest rule.  Tests use the lowered line, values the original.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajex.schema import METADATA_COLUMNS, TEST_ACTIVITY

FIELDS = ["start_recording", "stop_recording", "target_type", "scenario", "side",
          "target_speed", "target_distance"]


def read_annotation_lines(spark: SparkSession, paths: str | list[str],
                          pattern: str | None = "*.txt") -> DataFrame:
    """Text files to (path, line_no, line).  Folders are read with all their
    sub-folders, files by ``pattern`` of their names (None: all).  A line ends
    at the newline, carriage return or both that it had; lines keep a trailing
    newline, as ``readlines`` does (also the last one of a file without).

    Files are read in splits, a large file by many tasks: a split's lines
    follow each other in its partition, and splits follow each other by their
    first byte, so ``line_no`` orders a file's lines (it is a place, not a
    count: numbers have gaps)."""
    raw = spark.read.text(paths, recursiveFileLookup=True, pathGlobFilter=pattern)
    # rows of one split share its start; the low bits count rows of a partition
    at = F.struct(F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("row"))
    return raw.select(F.col("_metadata.file_path").alias("path"), at.alias("line_no"), F.concat("value", F.lit("\n")).alias("line"))


def _strip(c: Column) -> Column:
    """Python ``str.strip()``: remove leading and trailing whitespace,
    newlines included."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def _after_last_colon(c: Column) -> Column:
    return F.when(F.instr(c, ":") > 0, _strip(F.regexp_extract(c, r"^.*:([^:]*)$", 1)))


def _before_last_colon(c: Column) -> Column:
    return _strip(F.when(F.instr(c, ":") > 0, F.regexp_extract(c, r"^(.*):[^:]*$", 1)).otherwise(c))


def _rules(line: Column, mois: Column) -> Column:
    """Array of (field, value, rule_no) candidates for one line."""
    low = F.lower(line)
    has = lambda s: low.contains(s)
    ped = has("pedestrian") | (has("ped") & ~has("stopped"))

    def cand(field, value, rule, cond):
        return F.when(cond, F.struct(F.lit(field).alias("f"), value.cast("string").alias("v"),
                                     F.lit(rule).alias("r")))

    m = mois
    crossing = F.lit("crossing")
    items = [
        cand("start_recording", _before_last_colon(line), 10, has("recording has started")),
        cand("stop_recording", _before_last_colon(line), 11, has("recording has stopped")),
        cand("target_type", F.lit("bike"), 50, m & (has("bike") | ped)),
        cand("target_type", F.lit("pedestrian"), 60, m & ped),
        cand("scenario", crossing, 70, m & has("target") & has("right")),
        cand("side", F.lit("right"), 71, m & has("right")),
        cand("scenario", crossing, 80, m & has("target") & has("left")),
        cand("side", F.lit("left"), 81, m & has("left")),
        cand("scenario", F.lit("longitudinal"), 90, m & has("center")),
        cand("side", F.lit("center"), 91, m & has("center")),
        cand("target_type", F.lit("bike"), 92, m & has("center")),
        cand("scenario", F.lit("longitudinal"), 100, m & has("follow bike")),
        cand("target_type", F.lit("bike"), 101, m & has("follow bike")),
        cand("target_speed", _after_last_colon(line), 110, m & has("kph") & line.contains(":")),
        cand("scenario", crossing, 111, m & has("kph")),
        cand("target_distance", _after_last_colon(line), 120, m & has(" m") & line.contains(":")),
        cand("scenario", crossing, 121, m & has(" m")),
    ]
    return F.filter(F.array(*items), lambda x: x.isNotNull())


# Fields set only by the MOIS rules (masked for other test functions).
MOIS_FIELDS = ["target_type", "scenario", "side", "target_speed", "target_distance"]


def parse_annotations(lines: DataFrame, full_text: bool = True) -> DataFrame:
    """One metadata row per annotation file (``annotation_filename``).
    Per field the value of the latest line wins, and within a line the
    latest rule; ``pass/fail`` joins the text after the last ':' of every
    line containing 'ok' with ', '; ``full_annotation`` joins all lines
    with one space.  Lines without ':' give no value for the rules that
    read after it.  Without ``full_text`` the column ``full_annotation`` is left
    out, and no row is as large as a file; ``line_no`` may be any type that
    orders a file's lines.

    One aggregation per file: each line first keeps its latest candidate
    per field (a higher-order ``filter`` + ``array_max`` on the line's
    candidate array), the aggregation keeps the latest line per field and
    the first line, and the MOIS-only fields are masked afterwards when the
    first line is not ``MOIS`` (every field comes from one rule family, so
    masking at the end equals testing the function on every line)."""
    def of_field(name: str):
        # a one-argument lambda: two-argument lambdas receive the index
        return lambda c: c["f"] == name

    def best(cands: Column) -> Column:
        return F.struct(*(F.array_max(F.transform(F.filter(cands, of_field(f)), lambda c: F.struct(c["r"].alias("r"), c["v"].alias("v"))))
                          .alias(f) for f in FIELDS))
    # the candidates are bound once, not worked out again for each field
    found = F.transform(F.array(_rules(F.col("line"), F.lit(True))), best)[0]
    pf = F.when(F.lower("line").contains("ok"), _after_last_colon(F.col("line")))
    ln = lines.select("path", "line_no", "line", pf.alias("_pf1"), found.alias("_b")).select(
        "path", "line_no", "line", "_pf1", *(F.col(f"_b.{f}").alias(f"_b_{f}") for f in FIELDS))
    per_file = ln.groupBy("path").agg(
        F.min_by("line", "line_no").alias("_l0"),
        *[F.max_by(F.col(f"_b_{f}.v"),
                   F.when(F.col(f"_b_{f}").isNotNull(), F.struct("line_no", F.col(f"_b_{f}.r"))))
          .alias(f) for f in FIELDS],
        F.transform(F.array_sort(F.collect_list(
            F.when(F.col("_pf1").isNotNull(), F.struct("line_no", F.col("_pf1").alias("v"))))),
            lambda x: x["v"]).alias("_pf"),
        *([F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))),
                                    lambda x: x["line"]), " ").alias("full_annotation")] if full_text else []))
    func = _strip(F.col("_l0"))
    mois = func == "MOIS"
    return per_file.select(
        path_recording_id(F.col("path")).alias("recording_id"),
        F.col("path").alias("annotation_filename"), func.alias("test_function"),
        F.lit(TEST_ACTIVITY).alias("test_activity"),
        *[F.when(mois, F.col(f)).alias(f) for f in ("scenario", "side", "target_type",
                                                      "target_speed", "target_distance")],
        F.when(F.size("_pf") > 0, F.array_join("_pf", ", ")).alias("pass/fail"),
        "start_recording", "stop_recording", *(["full_annotation"] if full_text else []))


def path_recording_id(path: Column) -> Column:
    """Recording id = third path part from the end plus ``_00``; null for
    shorter paths."""
    return F.concat(F.try_element_at(F.split(path, "/"), F.lit(-3)), F.lit("_00"))


def recording_id_parts(df: DataFrame, col: str = "recording_id") -> DataFrame:
    """Vehicle id = part 0, test date = part 1 (yyyyMMdd) of the id; null
    where the id has no such part or it is no date."""
    parts = F.split(F.col(col), "_")
    return (df.withColumn("vehicle_id", F.element_at(parts, 1))
            .withColumn("test_date", F.try_to_date(F.try_element_at(parts, F.lit(2)), "yyyyMMdd")))


def metadata_build(parsed: DataFrame, dbc_mapping: str | None = None) -> DataFrame:
    """One row per recording (the first annotation file by name), the
    metadata columns, vehicle and date parts, and the CAN channel to DBC
    mapping text of the test campaign (a constant the caller supplies)."""
    from pyspark.sql import Window
    w = Window.partitionBy("recording_id").orderBy("annotation_filename")
    one = parsed.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(*METADATA_COLUMNS)
    return recording_id_parts(one).withColumn("channel_dbc_mapping", F.lit(dbc_mapping).cast("string"))
