"""Polyline geometry as Spark Column expressions.

Polylines are two parallel arrays.  Every function is a higher-order
expression over the arrays, so it runs inside whole-stage codegen on the
executors; no Python per row.  x and y are zipped to the shorter length,
as Python ``zip`` does.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _n(x: str, y: str) -> str:
    return f"least(size({x}), size({y}))"


def _seg_dist(x: str, y: str, px: str, py: str, k: str = "k") -> str:
    """Distance from (px, py) to the segment k..k+1 (0-based)."""
    ax, ay = f"{x}[{k}]", f"{y}[{k}]"
    vx, vy = f"({x}[{k} + 1] - {ax})", f"({y}[{k} + 1] - {ay})"
    wx, wy = f"({px} - {ax})", f"({py} - {ay})"
    ll = f"({vx} * {vx} + {vy} * {vy})"
    t = (f"(case when {ll} = 0 then 0D else greatest(0D, least(1D, "
         f"({wx} * {vx} + {wy} * {vy}) / {ll})) end)")
    dx, dy = f"({wx} - {t} * {vx})", f"({wy} - {t} * {vy})"
    return f"sqrt({dx} * {dx} + {dy} * {dy})"


def polyline_length(x: str = "BoundaryLineX", y: str = "BoundaryLineY") -> Column:
    """Sum of segment lengths; empty or one point gives 0."""
    n = _n(x, y)
    seg = (f"sqrt(pow({x}[k + 1] - {x}[k], 2) + pow({y}[k + 1] - {y}[k], 2))")
    return F.expr(f"case when {n} >= 2 then aggregate(sequence(0, {n} - 2), 0D, "
                  f"(acc, k) -> acc + {seg}) else 0D end")


def polyline_straightness(x: str = "BoundaryLineX", y: str = "BoundaryLineY") -> Column:
    """R2 of the least-squares line y = a + b*x.  Two points or fewer
    give 1; constant y gives 1; constant x (with varying y) gives 0.

    Two linear passes over the points: the means, then the centred sums
    Sxx, Syy, Sxy in one fold.  Each intermediate is bound once through a
    one-element ``transform`` so it is not re-evaluated per point."""
    n = _n(x, y)
    means = (f"named_struct('mx', aggregate(slice({x}, 1, {n}), 0D, (a, v) -> a + v) / {n}, "
             f"'my', aggregate(slice({y}, 1, {n}), 0D, (a, v) -> a + v) / {n})")
    sums = (f"aggregate(sequence(0, {n} - 1), named_struct('xx', 0D, 'yy', 0D, 'xy', 0D), "
            f"(s, k) -> named_struct("
            f"'xx', s.xx + ({x}[k] - m.mx) * ({x}[k] - m.mx), "
            f"'yy', s.yy + ({y}[k] - m.my) * ({y}[k] - m.my), "
            f"'xy', s.xy + ({x}[k] - m.mx) * ({y}[k] - m.my)))")
    r2 = ("case when c.yy = 0 then 1D when c.xx = 0 then 0D "
          "else c.xy * c.xy / (c.xx * c.yy) end")
    body = f"element_at(transform(array({sums}), c -> {r2}), 1)"
    return F.expr(f"case when {n} <= 2 then 1D else "
                  f"element_at(transform(array({means}), m -> {body}), 1) end")


def point_near_polyline(x: str, y: str, px: str, py: str, distance: float) -> Column:
    """The point lies closer than ``distance`` to the polyline (minimum
    point-to-segment distance).  Fewer than two points gives false."""
    n = _n(x, y)
    return F.expr(f"case when {n} < 2 then false else exists(sequence(0, {n} - 2), "
                  f"k -> {_seg_dist(x, y, px, py)} < {distance!r}) end")


def point_segment_distance(ax: str, ay: str, bx: str, by: str, px: Column, py: Column) -> Column:
    """Distance from a point to the segment from (ax, ay) to (bx, by)."""
    vx, vy = F.col(bx) - F.col(ax), F.col(by) - F.col(ay)
    wx, wy = px - F.col(ax), py - F.col(ay)
    along = F.coalesce(F.try_divide(wx * vx + wy * vy, vx * vx + vy * vy), F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), along))
    return F.hypot(wx - t * vx, wy - t * vy)
