"""Scene geometry: straight road, lane-change validation, boundary crossing
(A12, A13, J5, J6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajex.functions import geometry as geo
from trajex.operators.cover import cover, levels_of, look_up
from trajex.schema import (CROSS_BUFFER_ANY, CROSS_BUFFER_VALIDATE,
                           STRAIGHT_R2_MIN, STRAIGHT_SHARE_MIN)
from trajex.session import bounded_rows, materialize

# Grid cell (same unit as positions) for the spatial join of J6.
CROSS_CELL = 2.0
# Pairs of a point and a segment that J6 tests in one cell before it cuts it.
CELL_PAIRS = 100_000


def range_join(points: DataFrame, windows: DataFrame, keys: list[str], t: str, lo: str, hi: str,
               unit: float, broadcast_max_rows: int | None = None) -> DataFrame:
    """Points inside [lo, hi] windows with equal keys, both ends inclusive; ends
    follow the rule of ``cover``.  An equi-join on (keys, level, cell) of the
    dyadic cover with smallest cells of width ``unit``: a window takes at most
    two rows, and a long group is split across many join keys.

    ``broadcast_max_rows`` broadcasts a window table proven that small; by
    default AQE decides from measured shuffle sizes."""
    wb = cover(windows, lo, hi, unit)
    pb = look_up(points, F.col(t), levels_of(wb), unit)
    if broadcast_max_rows is not None and bounded_rows(windows, broadcast_max_rows):
        wb = F.broadcast(wb)
    return (pb.join(wb, [*keys, "_lv", "_b"]).where((F.col(t) >= F.col(lo)) & (F.col(t) <= F.col(hi)))
            .drop("_lv", "_b"))


def scene_straightness(lines: DataFrame, scene: list[str], r2_min: float = STRAIGHT_R2_MIN,
                       share_min: float = STRAIGHT_SHARE_MIN) -> DataFrame:
    """Per scene, the share of line length on lines with R2 > r2_min;
    straight when the share exceeds share_min.  A scene of zero total length
    has a null share and is not straight."""
    per_line = lines.select(*scene, geo.polyline_length().alias("_len"),
                            geo.polyline_straightness().alias("_r2"))
    agg = per_line.groupBy(*scene).agg(
        F.sum(F.when(F.col("_r2") > r2_min, F.col("_len")).otherwise(0.0)).alias("_straight"),
        F.sum("_len").alias("_total"))
    share = F.try_divide(F.col("_straight"), F.col("_total"))
    return agg.select(*scene, share.alias("straight_share"),
                      F.coalesce(share > share_min, F.lit(False)).alias("is_straight"))


def straight_times(lines: DataFrame, scene: list[str], **kw) -> DataFrame:
    """Scenes that are straight."""
    return scene_straightness(lines, scene, **kw).where("is_straight").select(*scene)


def lane_change_validate(windows: DataFrame, ego: DataFrame, lines: DataFrame, group: list[str], *,
                         line_intervals: DataFrame | None = None, buffer: float = CROSS_BUFFER_VALIDATE,
                         first_only: bool = True, distinct: bool = False,
                         window_key: str = "i", unit: float = 12.0) -> DataFrame:
    """Keep a window once per lane line that passes within ``buffer`` of
    the ego position at the first ego row inside the window (lines taken at
    exactly that time).  ``first_only=False`` tests every ego row of the
    window; ``distinct=True`` returns each accepted window once.

    ``windows`` has group columns, ``window_key``, lc_start, lc_end; ``ego``
    has group columns, ptp_time, PositionX, PositionY; ``lines`` has
    recording_id, ptp_time, BoundaryLineX/Y.  ``line_intervals`` (group
    columns, start_time, end_time) limits lines to the unpadded interval."""
    win = windows.select(*group, window_key, "lc_start", "lc_end")
    extra = []
    if line_intervals is not None:
        # the few windows carry their interval's bounds; lines outside the
        # unpadded interval are then dropped by a filter, not a join
        li = line_intervals.select(*group, F.col("start_time").alias("_ls"), F.col("end_time").alias("_le"))
        win, extra = win.join(li, group), ["_ls", "_le"]
    inside = range_join(ego.select(*group, "ptp_time", "PositionX", "PositionY"), win,
                        group, "ptp_time", "lc_start", "lc_end", unit)
    wkey = [*group, window_key, "lc_start", "lc_end"]
    if first_only:
        first = inside.groupBy(*wkey, *extra).agg(
            F.min(F.struct("ptp_time", "PositionX", "PositionY")).alias("_e"))
        inside = first.select(*wkey, *extra, "_e.ptp_time", "_e.PositionX", "_e.PositionY")
    if extra:
        inside = inside.where(F.col("ptp_time").between(F.col("_ls"), F.col("_le")))
    ln = lines.select("recording_id", F.col("ptp_time"), "BoundaryLineX", "BoundaryLineY")
    cand = inside.join(ln, ["recording_id", "ptp_time"])
    hits = cand.where(geo.point_near_polyline("BoundaryLineX", "BoundaryLineY", "PositionX",
                                              "PositionY", buffer))
    out = hits.select(*wkey)
    return out.distinct() if distinct else out


def segment_cells(seg: DataFrame, buffer: float, cell: float) -> DataFrame:
    """One row per segment (ax, ay)-(bx, by) and grid cell (_cx, _cy) that can
    hold a point within ``buffer`` of it inside the box (_x0, _y0)-(_x1, _y1).

    Cells follow the segment: per column of cells only the part of the segment
    within ``buffer`` of the column counts, so their number grows with the
    segment's length inside the box, not with the area of its bounding box."""
    reach = buffer + 1e-6  # more than the rounding of the interpolation
    x_lo = F.greatest(F.least("ax", "bx") - reach, F.col("_x0"))
    x_hi = F.least(F.greatest("ax", "bx") + reach, F.col("_x1"))
    cols = seg.where(x_lo <= x_hi).withColumn("_cx", F.explode(F.sequence(F.floor(x_lo / cell), F.floor(x_hi / cell))))
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    at = [F.try_divide(side - F.col("ax"), dx) for side in (F.col("_cx") * cell - reach, (F.col("_cx") + 1) * cell + reach)]
    # an upright segment has no such shares (null): the whole of it counts
    y_in = F.col("ay") + dy * F.greatest(F.lit(0.0), F.least(*at))
    y_out = F.col("ay") + dy * F.least(F.lit(1.0), F.greatest(*at))
    rows = (cols.withColumn("_lo", F.greatest(F.least(y_in, y_out) - reach, F.col("_y0")))
            .withColumn("_hi", F.least(F.greatest(y_in, y_out) + reach, F.col("_y1"))))
    return (rows.where("_lo <= _hi")
            .withColumn("_cy", F.explode(F.sequence(F.floor(F.col("_lo") / cell), F.floor(F.col("_hi") / cell))))
            .drop("_lo", "_hi"))


def split_cells(points: DataFrame, seg: DataFrame, slice_key: list[str], buffer: float, cell: float) -> tuple[DataFrame, DataFrame]:
    """Points (slice_key, PositionX, PositionY, _et) with their cell, and the
    segments near each cell that holds points; of a segment and a cell it is
    known whether all (``_sure``) or some of the cell's points can be within
    ``buffer`` of it."""
    pts = points.withColumn("_cx", F.floor(F.col("PositionX") / cell)).withColumn("_cy", F.floor(F.col("PositionY") / cell))
    held = pts.groupBy(*slice_key, "_cx", "_cy").agg(
        F.min("_et").alias("_emin"), F.min("PositionX").alias("_px0"), F.max("PositionX").alias("_px1"),
        F.min("PositionY").alias("_py0"), F.max("PositionY").alias("_py1"), F.count(F.lit(1)).alias("_n"))
    near = seg.join(held, [*slice_key, "_cx", "_cy"]).where(F.col("_lt") > F.col("_emin"))
    # all points of the cell lie within ``half`` of the middle of their box
    half = F.sqrt(F.pow(F.col("_px1") - F.col("_px0"), 2) + F.pow(F.col("_py1") - F.col("_py0"), 2)) / 2 + 1e-9
    away = geo.point_segment_distance("ax", "ay", "bx", "by", (F.col("_px0") + F.col("_px1")) / 2, (F.col("_py0") + F.col("_py1")) / 2)
    near = near.withColumn("_half", half).withColumn("_away", away).where(F.col("_away") - F.col("_half") < buffer)
    return pts, near.withColumn("_sure", F.col("_away") + F.col("_half") < buffer)


def boundary_cross_any(ego: DataFrame, lines: DataFrame, slices: DataFrame, slice_key: list[str], *,
                       buffer: float = CROSS_BUFFER_ANY, cell: float = CROSS_CELL, pairs: int = CELL_PAIRS) -> DataFrame:
    """Per slice, whether any ego position lies within ``buffer`` of any
    lane line recorded strictly later in the same slice.

    A spatial grid join with cells that adapt to the data.  Each line segment
    is copied to the grid cells along it that lie in the box of the slice's
    positions, each position goes to its cell.  A segment that is within
    ``buffer`` of the whole box of a cell's points needs no pairs: it decides
    the slice if it is later than the cell's earliest point, and a segment that
    is beyond ``buffer`` of the whole box is dropped.  What is left are borders:
    cells with at most ``pairs`` pairs of a point and a segment are tested pair
    by pair, the others are cut in four and looked at again, which makes the
    border narrower each time.  A slice that is decided drops out at once.  In
    a cell of a hundredth of ``buffer`` pairs are tested whatever their number,
    but then only earliest points at different places and latest segments.

    Repeated positions keep their earliest and repeated segments their latest
    time, which decide alone; NaN and null positions are no places.  Returns every slice with a boolean ``crossed``.

    ``slices`` has slice_key columns (including recording_id), start_time,
    end_time; ego and lines are restricted to each slice."""
    sl = slices.select(*slice_key, "start_time", "end_time")
    keep = tuple(c for c in slice_key if c != "recording_id")
    from trajex.operators.filters import within_intervals
    placed = ego.select("recording_id", "ptp_time", "PositionX", "PositionY").where("NOT isnan(PositionX) AND NOT isnan(PositionY)")
    e = within_intervals(placed, sl, keep=keep)
    # positions feed the boxes, the cells and the pairs: write once
    e = materialize(e.groupBy(*slice_key, "PositionX", "PositionY").agg(F.min("ptp_time").alias("_et")), "cross_points")
    ln = within_intervals(lines.select("recording_id", "ptp_time", "BoundaryLineX", "BoundaryLineY"),
                          sl, keep=keep)
    n = "least(size(BoundaryLineX), size(BoundaryLineY))"
    seg = (ln.where(F.expr(f"{n} >= 2"))
           .select(*slice_key, F.col("ptp_time").alias("_lt"),
                   F.explode(F.expr(f"transform(sequence(0, {n} - 2), k -> named_struct("
                                    "'ax', BoundaryLineX[k], 'ay', BoundaryLineY[k], "
                                    "'bx', BoundaryLineX[k + 1], 'by', BoundaryLineY[k + 1]))")).alias("_s"))
           .select(*slice_key, "_lt", "_s.*"))
    seg = seg.groupBy(*slice_key, "ax", "ay", "bx", "by").agg(F.max("_lt").alias("_lt"))
    # only the part of a segment near the slice's positions gets cells
    box = e.groupBy(*slice_key).agg(
        F.min("_et").alias("_emin"), F.min("PositionX").alias("_x0"), F.max("PositionX").alias("_x1"),
        F.min("PositionY").alias("_y0"), F.max("PositionY").alias("_y1"))
    boxed = seg.join(box, slice_key).where(F.col("_lt") > F.col("_emin")).drop("_emin")
    ends = ["_x0", "_x1", "_y0", "_y1"]
    hits, size = [], cell
    while True:
        pts, near = split_cells(e, segment_cells(boxed, buffer, size).drop(*ends), slice_key, buffer, size)
        near = materialize(near, "cross_cells")
        sure = near.where("_sure").select(*slice_key).distinct()
        at = [*slice_key, "_cx", "_cy"]
        # what one pair of the slice decides needs no further look
        left = near.where("NOT _sure").join(sure, slice_key, "left_anti")
        last = size <= buffer / 100
        load = left.groupBy(*at).agg((F.first("_n") * F.count(F.lit(1))).alias("_load")).withColumn("_heavy", (F.col("_load") > pairs) & F.lit(not last))
        light = left.join(load.where("NOT _heavy").select(*at), at)
        pair = pts.join(light.select(*at, "_lt", F.array("ax", "bx").alias("_sx"), F.array("ay", "by").alias("_sy")), at)
        hit = pair.where((F.col("_lt") > F.col("_et")) & geo.point_near_polyline("_sx", "_sy", "PositionX", "PositionY", buffer))
        hits.append(materialize(sure.unionByName(hit.select(*slice_key).distinct()).distinct(), "crossed"))
        if last:
            break
        open_ = load.where("_heavy").join(hits[-1], slice_key, "left_anti").select(*at)
        e_open = materialize(pts.join(open_, at, "left_semi").drop("_cx", "_cy"), "cross_points")
        if e_open.isEmpty():
            break
        # the segments of heavy cells, within the box of the points left
        seg = left.join(open_, at, "left_semi").select(*slice_key, "ax", "ay", "bx", "by", "_lt").distinct()
        box = e_open.groupBy(*slice_key).agg(F.min("PositionX").alias("_x0"), F.max("PositionX").alias("_x1"),
                                             F.min("PositionY").alias("_y0"), F.max("PositionY").alias("_y1"))
        boxed, e, size = seg.join(box, slice_key), e_open, size / 2
    crossed = hits[0]
    for more in hits[1:]:
        crossed = crossed.unionByName(more)
    crossed = crossed.distinct().withColumn("crossed", F.lit(True))
    return (slices.select(*slice_key).distinct().join(crossed, slice_key, "left")
            .withColumn("crossed", F.coalesce(F.col("crossed"), F.lit(False))))
