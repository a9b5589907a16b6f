"""Interval sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajex.schema import INTERVAL_SCHEMA


def read_interval_csv(spark: SparkSession, path: str) -> DataFrame:
    """Flat interval CSV with a header (recording_id, start_time,
    end_time); times read as double by a declared schema, no inference."""
    return spark.read.schema(INTERVAL_SCHEMA).option("header", True).csv(path)


def read_interval_list_csv(spark: SparkSession, path: str) -> DataFrame:
    """S4 source: CSV whose 2nd column is the recording and 3rd a list text
    ``[[a, b], ...]`` (1st is a row index)."""
    raw = spark.read.option("header", True).csv(path)
    cols = raw.columns
    return raw.select(F.col(cols[1]).alias("recording_id"), F.col(cols[2]).alias("intervals"))


def explode_interval_list(df: DataFrame, text_col: str = "intervals") -> DataFrame:
    """One row per (recording, position) from a cell with a list of pairs,
    ``[[a, b], ...]`` or with tuples, ``[(a, b), ...]``.  Null and blank cells
    give no rows; a cell that cannot be read fails."""
    text = F.col(text_col)
    # brackets for parentheses, and no comma before a closing one
    listed = F.regexp_replace(F.translate(text, "()", "[]"), ",\\s*\\]", "]")
    parsed = F.from_json(listed, "array<array<double>>")
    arr = (F.when(F.trim(F.coalesce(text, F.lit(""))) == "", F.array().cast("array<array<double>>"))
           .when(parsed.isNull() | F.exists(parsed, lambda p: p.isNull() | (F.size(p) != 2)),
                 F.raise_error(F.concat(F.lit("not a list of intervals: "), text)))
           .otherwise(parsed))
    return (df.select("recording_id", F.posexplode(arr).alias("pos", "_p"))
            .select("recording_id", "pos", F.col("_p")[0].alias("start_time"),
                    F.col("_p")[1].alias("end_time")))
