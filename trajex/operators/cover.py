"""Dyadic interval cover: range joins as equi-joins.

Level l cuts the number line into cells of width ``unit * 2**l``.  An interval
lies at the level whose cells are at least as long as it is, so it covers at
most two cells whatever its length; a point looks up one cell at each level
that some interval uses (at most ``TOP`` + 1, usually one to three).  Equal
(level, cell) is necessary for a point to lie in an interval; the range itself
stays as a residual condition.

One rule for ends: an interval with a null or NaN end, or with its ends the
wrong way round, holds no point; infinite ends are open ends; a null or NaN
point lies in no interval.

Totals of an interval need no pairs: the cells of one width that lie between
the cells of its ends belong to it whole, and ``blocks`` names them by at most
two cells a level, so totals of cells (``tower``) stand for their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Highest level; longer and infinite intervals stand there.
TOP = 40
#: Cells of one width are numbered up to here; longer times share the last.
FAR = 2.0 ** 61


def holds(a: Column, b: Column) -> Column:
    """Whether an interval can hold a point."""
    return a.isNotNull() & b.isNotNull() & ~F.isnan(a) & ~F.isnan(b) & (a <= b)


def cover(df: DataFrame, lo: str, hi: str, unit: float) -> DataFrame:
    """``df`` with ``_lv`` and ``_b``, one row per cell of its interval (one or
    two); intervals that hold no point have none."""
    a, b = F.col(lo).cast("double"), F.col(hi).cast("double")
    length = b - a
    level = (F.when(length <= unit, 0).when(length >= unit * 2.0 ** TOP, TOP)
             .otherwise(F.ceil(F.log2(length / unit))).cast("int"))
    width = F.pow(F.lit(2.0), F.col("_lv")) * unit
    # at the highest level one cell on either side of 0 holds everything
    top = F.col("_lv") == TOP
    first = F.when(top, F.lit(-1)).otherwise(F.floor(a / width)).cast("long")
    last = F.when(top, F.lit(0)).otherwise(F.floor(b / width)).cast("long")
    held = df.where(holds(a, b))
    return held.withColumn("_lv", level).withColumn("_b", F.explode(F.sequence(first, last)))


def levels_of(covered: DataFrame) -> list[int]:
    """The levels that a cover uses, found in one job."""
    return sorted(r["_lv"] for r in covered.select("_lv").distinct().collect())  # at most TOP + 1 rows


def place(t: Column, level: int, unit: float) -> Column:
    """The cell of a time at a level."""
    t = t.cast("double")
    if level == TOP:
        return F.when(t < 0, F.lit(-1)).otherwise(F.lit(0)).cast("long")
    return F.floor(t / (unit * 2.0 ** level)).cast("long")


def look_up(df: DataFrame, t: Column, levels: list[int], unit: float) -> DataFrame:
    """``df`` with ``_lv`` and ``_b``: a row per level, with the cell of ``t``."""
    if len(levels) == 1:
        return df.withColumn("_lv", F.lit(levels[0])).withColumn("_b", place(t, levels[0], unit))
    cells = F.array(*(F.struct(F.lit(v).alias("_lv"), place(t, v, unit).alias("_b")) for v in levels))
    at = df.withColumn("_cell", F.explode(cells if levels else cells.cast("array<struct<_lv:int,_b:bigint>>")))
    return at.withColumn("_lv", F.col("_cell._lv")).withColumn("_b", F.col("_cell._b")).drop("_cell")


def cell(t: Column, unit: float) -> Column:
    """The number of a time's cell among cells of one width.  It never falls as
    the time grows, infinite times included, so whatever lies in a cell between
    those of two times lies between the times."""
    return F.floor(F.least(F.greatest(t.cast("double") / unit, F.lit(-FAR)), F.lit(FAR))).cast("long")


def top_of(cells: Column) -> Column:
    """The highest level of which a run of so many cells can hold a cell."""
    return F.length(F.bin(cells)) - 1


def blocks(df: DataFrame, first: str, past: str) -> DataFrame:
    """``df`` with ``_lv`` and ``_b``: the cells ``first`` to ``past - 1`` as
    few cells of ``2**_lv`` of them, at most two a level."""
    run = df.where(F.col(first) < F.col(past))
    at = (run.withColumn("_lv", F.explode(F.sequence(F.lit(0), top_of(F.col(past) - F.col(first)))))
          .withColumn("_l", F.expr(f"-shiftright(-{first}, _lv)")).withColumn("_r", F.expr(f"shiftright({past}, _lv)"))
          .where("_l < _r"))
    # a cell whose other half is outside the run stands for itself
    odd = F.array(F.when(F.col("_l") % 2 != 0, F.col("_l")), F.when(F.col("_r") % 2 != 0, F.col("_r") - 1))
    return at.withColumn("_b", F.explode(odd)).where(F.col("_b").isNotNull()).drop("_l", "_r")


def tower(cells: DataFrame, cells_in_run: Column, key: list[str], *aggs: Column) -> DataFrame:
    """Cells ``_b`` of each ``key`` put together to the cells of every level
    that a run of ``cells_in_run`` can hold."""
    levels = cells.withColumn("_lv", F.explode(F.sequence(F.lit(0), top_of(cells_in_run))))
    return levels.withColumn("_b", F.expr("shiftright(_b, _lv)")).groupBy(*key, "_lv", "_b").agg(*aggs)
