"""Projections, filters and the interval range join."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajex.operators.cover import blocks, cell, cover, holds, levels_of, look_up, tower
from trajex.schema import (EGO_PAD_SECONDS, HIGHWAY_ROAD_TAGS, OBJECT_COLUMNS,
                           STATUS_COLUMNS, Thresholds)
from trajex.session import bounded_rows, materialize

# Interval tables above this many rows are not broadcast; they are shuffled.
BROADCAST_MAX_ROWS = 250_000
# Width (seconds) of the smallest cells of the interval cover.
RANGE_BUCKET_SECONDS = 60.0
# ``interval_totals`` takes narrower cells where one holds more times than this,
# down to RANGE_BUCKET_SECONDS / 2**FINEST.
CELL_TIMES = 256
FINEST = 24


def time_grid(c: Column | str, digits: int = 1) -> Column:
    """F2: put a time on the 0.1 s grid (half-up on the decimal value)."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits)


def within_intervals(df: DataFrame, intervals: DataFrame, *, time_col: str = "ptp_time",
                     start_col: str = "start_time", end_col: str = "end_time",
                     keep: tuple[str, ...] = (), broadcast_max_rows: int = BROADCAST_MAX_ROWS,
                     bucket_seconds: float = RANGE_BUCKET_SECONDS,
                     broadcast: bool | None = None) -> DataFrame:
    """Inner range join: rows of ``df`` whose time lies in an interval of the
    same recording, both ends inclusive.  A row inside two overlapping
    intervals appears twice.  Interval columns named in ``keep`` stay.  Ends
    follow the rule of ``cover``: null, NaN or reversed ends hold no row,
    infinite ends are open.

    An equi-join on (recording, level, cell) of the dyadic cover with the range
    as a residual: an interval takes at most two rows, however long it is, and
    a signal row one per level that the intervals use.  Small interval tables
    (row count checked) are broadcast, so the signal side is never shuffled;
    larger ones are shuffled, and a hot recording spreads over many join keys.
    ``broadcast`` passes an earlier check's answer (None: check here).
    """
    iv = intervals.select("recording_id", F.col(start_col).alias("_lo"), F.col(end_col).alias("_hi"), *keep)
    covered = cover(iv, "_lo", "_hi", float(bucket_seconds))
    t = F.col(time_col)
    sig = look_up(df, t, levels_of(covered), float(bucket_seconds))
    if broadcast is None:
        broadcast = intervals_broadcastable(intervals, broadcast_max_rows)
    joined = sig.join(F.broadcast(covered) if broadcast else covered, ["recording_id", "_lv", "_b"])
    return joined.where((t >= F.col("_lo")) & (t <= F.col("_hi"))).drop("_lv", "_b", "_lo", "_hi")


def intervals_broadcastable(intervals: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """The broadcast decision of ``within_intervals``, for reuse when one
    interval table filters several streams; covers have at most two rows per
    interval."""
    return bounded_rows(intervals, max_rows // 2)


def _cell_totals(rows: DataFrame, unit: float) -> tuple[DataFrame, int]:
    """Totals of each cell, written once, and the rows of the fullest."""
    t = F.col("_t")
    cells = materialize(rows.groupBy("recording_id", cell(t, unit).alias("_b"))
                        .agg(F.sum("_n").alias("_n"), F.min(t).alias("_first"), F.max(t).alias("_last"),
                             F.count(F.lit(1)).alias("_rows")), "cells")
    return cells, cells.agg(F.max("_rows")).first()[0] or 0


def interval_totals(df: DataFrame, intervals: DataFrame, *, time_col: str = "ptp_time",
                    start_col: str = "start_time", end_col: str = "end_time", keep: tuple[str, ...] = (),
                    bucket_seconds: float = RANGE_BUCKET_SECONDS, cell_times: int = CELL_TIMES) -> DataFrame:
    """Per recording and ``keep``: the number ``n`` of (row, interval) pairs of
    ``within_intervals`` and the ``first`` and ``last`` of their times, where
    there is a pair.

    Pairs grow with rows times intervals when intervals are long or open, so
    only rows in the cells of an interval's two ends are paired, by
    ``within_intervals`` on that part of the interval.  Cells between them, and
    end cells that lie in it whole, count by their totals.  Where some cell
    holds over ``cell_times`` rows, equal times become one row with its number
    and the cells are made narrower."""
    t, key = F.col("_t"), ["recording_id", *keep]
    rows = df.select("recording_id", F.col(time_col).alias("_t"), F.lit(1).cast("long").alias("_n"))
    rows = rows.where(t.isNotNull() & ~F.isnan(t.cast("double")) & F.col("recording_id").isNotNull())
    unit = float(bucket_seconds)
    cells, most = _cell_totals(rows, unit)
    if most > cell_times:
        rows = materialize(rows.groupBy("recording_id", "_t").agg(F.sum("_n").alias("_n")), "times")
    finest = unit / 2.0 ** FINEST
    while most > cell_times and unit > finest:
        unit = max(finest, unit / 2.0 ** max(4, math.ceil(math.log2(most / cell_times))))
        cells, most = _cell_totals(rows, unit)

    lo, hi = F.col("_lo"), F.col("_hi")
    iv = (intervals.select("recording_id", F.col(start_col).cast("double").alias("_lo"), F.col(end_col).cast("double").alias("_hi"), *keep)
          .where(holds(lo, hi)).withColumn("_a", cell(lo, unit)).withColumn("_z", cell(hi, unit)))
    found = [*key, "_n", "_first", "_last"]

    ends = iv.withColumn("_b", F.explode(F.array_distinct(F.array("_a", "_z")))).join(cells, ["recording_id", "_b"])
    whole = (lo <= F.col("_first")) & (F.col("_last") <= hi)
    part = (ends.where(~whole & (lo <= F.col("_last")) & (F.col("_first") <= hi))
            .select(*key, F.greatest(lo, "_first").alias("_from"), F.least(hi, "_last").alias("_to")))
    at_ends = within_intervals(rows, part, time_col="_t", start_col="_from", end_col="_to", keep=keep, bucket_seconds=unit)

    # beyond the recording's own cells there is nothing to count
    span = cells.groupBy("recording_id").agg(F.min("_b").alias("_least"), F.max("_b").alias("_most"))
    runs = (iv.join(span, "recording_id")
            .select(*key, F.greatest(F.col("_a") + 1, "_least").alias("_l0"), F.least("_z", F.col("_most") + 1).alias("_r0")))
    levels = tower(cells.join(span, "recording_id"), F.col("_most") - F.col("_least") + 1, ["recording_id"],
                   F.sum("_n").alias("_n"), F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    between = blocks(runs, "_l0", "_r0").join(levels, ["recording_id", "_lv", "_b"])

    parts = (ends.where(whole).select(*found).unionByName(between.select(*found))
             .unionByName(at_ends.select(*key, "_n", t.alias("_first"), t.alias("_last"))))
    return parts.groupBy(*key).agg(F.sum("_n").alias("n"), F.min("_first").alias("first"), F.max("_last").alias("last"))


def highway_filter(df: DataFrame, intervals: DataFrame, *, time_col: str = "ptp_time",
                   **kw) -> DataFrame:
    """Keep rows inside a highway interval, then put time on the grid."""
    out = within_intervals(df, intervals, time_col=time_col, **kw)
    return out.withColumn(time_col, time_grid(time_col))


def ego_speed(df: DataFrame, vx: str = "VelocityX", vy: str = "VelocityY",
              out: str = "Velocity") -> DataFrame:
    """planar speed."""
    return df.withColumn(out, F.sqrt(F.pow(F.col(vx), 2) + F.pow(F.col(vy), 2)))


def object_roi_condition(th: Thresholds = Thresholds()) -> Column:
    c = F.col
    return ((F.abs(c("VelocityX")) < th.velocity_x_max)
            & (F.abs(c("VelocityY")) < th.velocity_y_max)
            & (F.abs(c("VelocityZ")) < th.velocity_z_max)
            & (c("VelocityX") > th.velocity_x_min)
            & (c("PositionY") < th.position_y_max)
            & (c("PositionY") > th.position_y_min)
            & (c("PositionX") < th.position_x_max))


def object_roi(df: DataFrame, th: Thresholds = Thresholds()) -> DataFrame:
    """plausibility and region-of-interest filter."""
    return df.where(object_roi_condition(th))


def object_dedup(df: DataFrame, key: list[str] | None = None) -> DataFrame:
    """drop duplicate objects on the object key, then on the full row.
    A stated ``key`` must be in the frame; without one the key is the object
    columns that the frame has.

    When the key covers every column one ``dropDuplicates`` does both.
    Otherwise the first row per key in a total order of the other columns is
    kept, which makes the choice deterministic.
    """
    if missing := [c for c in key or () if c not in df.columns]:
        raise ValueError(f"key columns not in the frame: {missing}")
    key = key or [c for c in OBJECT_COLUMNS if c in df.columns]
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.dropDuplicates()
    from pyspark.sql import Window
    w = Window.partitionBy(*key).orderBy(*[F.col(c).asc_nulls_first() for c in rest])
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def filter_objects(df: DataFrame, th: Thresholds = Thresholds()) -> DataFrame:
    """F4 + F5 in the cheap order: the filter runs before the dedup shuffle.
    Equivalent to dedup-then-filter because the dedup key is the full row."""
    return object_dedup(object_roi(df, th))


def time_slice(df: DataFrame, lo: float | Column, hi: float | Column, *,
               recording_id: str | None = None, time_col: str = "ptp_time") -> DataFrame:
    """inclusive time slice, optionally of one recording.  Literal bounds
    reach the parquet scan as pushed filters."""
    out = df if recording_id is None else df.where(F.col("recording_id") == recording_id)
    return out.where(F.col(time_col).between(lo, hi))


def seconds_from_text(text: str | Column) -> Column:
    """datetime text (read as UTC wall time, like a naive pandas
    timestamp) to whole epoch seconds, truncated; times are positive.
    Parsed without a zone, so the session time zone does not matter."""
    c = F.lit(text) if isinstance(text, str) else text
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, F.to_timestamp_ntz(c))


def time_slice_text(df: DataFrame, start_text: str, end_text: str, **kw) -> DataFrame:
    """F7 + F6: slice by bounds given as datetime text."""
    return time_slice(df, seconds_from_text(start_text), seconds_from_text(end_text), **kw)


def status_projection(df: DataFrame) -> DataFrame:
    """F8: keep the 13 status columns, rounded time becomes ``ptp_time``."""
    return df.select(*STATUS_COLUMNS).withColumnRenamed("ptp_time_rounded", "ptp_time")


def constant_columns(df: DataFrame) -> list[str]:
    """Columns with exactly one distinct value, NaN and null not counted
    (pandas ``nunique() == 1``).

    One aggregation with O(1) state per column (min, max) instead of a
    distinct count: a column is constant iff min equals max and min is not
    null.  NaN is first turned into null in floating columns."""
    def val(c: str) -> Column:
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            return F.when(~F.isnan(c), F.col(c))
        return F.col(c)
    aggs = [(F.min(val(c)).isNotNull() & (F.min(val(c)) == F.max(val(c)))).alias(c) for c in df.columns]
    row = df.agg(*aggs).first()
    return [c for c in df.columns if row[c]]


def drop_constant_columns(df: DataFrame) -> DataFrame:
    """drop columns with exactly one distinct value (all-null columns stay)."""
    return df.drop(*constant_columns(df))


def road_type_filter(df: DataFrame, recording_id: str | None = None,
                     road_tags: list[str] = HIGHWAY_ROAD_TAGS) -> DataFrame:
    """highway road-type tags, optionally for one recording."""
    out = df.where(F.col("tag_name_list").isin(*road_tags))
    return out if recording_id is None else out.where(F.col("recording_id") == recording_id)


def country_group(df: DataFrame) -> DataFrame:
    """label rows europe / japan / brazil; 'no country' gets null.  A
    missing country counts as Europe, as pandas' ``!=`` makes it."""
    c = F.col("country")
    return df.withColumn("country_group",
                         F.when(c == "Japan", "japan").when(c == "Brazil", "brazil")
                         .when(c.isNull() | (c != "no country"), "europe"))


def country_split(df: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(europe, japan, brazil); a missing country counts as Europe."""
    c = F.col("country")
    europe = df.where(c.isNull() | ~c.isin("no country", "Japan", "Brazil"))
    return europe, df.where(c == "Japan"), df.where(c == "Brazil")


def odd_motion(df: DataFrame, vy_min: float = 15, vx_abs_max: float = 2) -> DataFrame:
    """sideways motion filter ``VelocityY > 15 and |VelocityX| < 2``."""
    return df.where((F.col("VelocityY") > vy_min) & (F.abs(F.col("VelocityX")) < vx_abs_max))


def turning_rows(df: DataFrame, yaw_rate_abs_min: float = 0.005) -> DataFrame:
    """``|YawRate| > 0.005``."""
    return df.where(F.abs(F.col("YawRate")) > yaw_rate_abs_min)


def interval_pad(intervals: DataFrame, pad: float = EGO_PAD_SECONDS,
                 start_col: str = "start_time", end_col: str = "end_time") -> DataFrame:
    """widen intervals by ``pad`` seconds on both sides."""
    return (intervals.withColumn(start_col, F.col(start_col) - pad)
            .withColumn(end_col, F.col(end_col) + pad))
