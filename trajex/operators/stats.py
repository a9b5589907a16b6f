"""Statistics over signals.

All of these are single aggregations (partial aggregation map-side, one
small shuffle).  Data-dependent shapes (extent of a histogram, moments of a
density) enter as scalar subqueries, so no action runs on the driver.

Null and NaN are missing values everywhere here, as in pandas: they are
counted, ranked, binned and located nowhere.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Grid points of the density that one row adds to, and the bandwidths beyond
#: which a value adds nothing.
GRID_BLOCK, REACH = 20, 9.0


def one_row(agg: DataFrame) -> Column:
    """The single row of an aggregate as a struct-valued scalar subquery.
    Every field read from the same Column is one subquery, computed once."""
    return agg.select(F.struct(*agg.columns)).scalar()


def known(df: DataFrame, col: str) -> Column:
    """The column with NaN as null."""
    c = F.col(f"`{col}`")
    return F.when(~F.isnan(c), c) if isinstance(df.schema[col].dataType, (T.DoubleType, T.FloatType)) else c


def signal_quantiles(df: DataFrame, col: str, probs=(0.25, 0.75), rel_error: float = 0.01,
                     group: list[str] | None = None) -> DataFrame:
    """A4: approximate quantiles with relative rank error ``rel_error`` (the
    ``approxQuantile(col, probs, 0.01)`` contract).  One sketch per group,
    merged across partitions; memory does not grow with the data."""
    acc = max(1, int(round(1.0 / rel_error)))
    aggs = [F.percentile_approx(known(df, col), p, acc).alias(f"q{int(round(p * 100)):02d}") for p in probs]
    return df.groupBy(*(group or [])).agg(*aggs)


def signal_extent(df: DataFrame, cols: list[str], group: list[str] | None = None) -> DataFrame:
    """A5: max and min of signals."""
    aggs = [a for c in cols for a in (F.max(known(df, c)).alias(f"max_{c}"), F.min(known(df, c)).alias(f"min_{c}"))]
    return df.groupBy(*(group or [])).agg(*aggs)


def distinct_counts(df: DataFrame, cols: list[str], group: list[str] | None = None,
                    exact: bool = True) -> DataFrame:
    """Distinct non-null values per column (``nunique``).  ``exact=False``
    uses HyperLogLog++ (fixed memory per group)."""
    f = F.count_distinct if exact else F.approx_count_distinct
    return df.groupBy(*(group or [])).agg(*[f(known(df, c)).alias(f"n_{c}") for c in cols])


def signal_sketches(df: DataFrame, cols: list[str], group: list[str], k: int = 400) -> DataFrame:
    """A4, A5, A6 as a stored table: per group and signal (column ``signal``) a
    KLL sketch of its values, a HyperLogLog sketch of its distinct values, and
    their number, least and greatest.  Rows of any groups merge into those of a
    coarser grouping (``merged_quantiles``), so new recordings are added without
    reading old ones again.

    ``k`` sets the size of the KLL sketch, some 3 * k doubles at most whatever
    the group's rows; the rank error of one quantile is below 2.296 / k ** 0.9
    with 99 % confidence, about 0.0104 for 400, merged or not."""
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("signal"), known(df, c).cast("double").alias("v")) for c in cols))).alias("s")
    rows = df.select(*group, each).select(*group, "s.signal", "s.v").where(F.col("v").isNotNull())
    return rows.groupBy(*group, "signal").agg(
        F.count(F.lit(1)).alias("n"), F.min("v").alias("least"), F.max("v").alias("greatest"),
        F.kll_sketch_agg_double("v", k).alias("kll"), F.hll_sketch_agg(F.col("v").cast("string")).alias("hll"))


def merged_quantiles(sketches: DataFrame, probs=(0.25, 0.75), group: list[str] | None = None) -> DataFrame:
    """Quantiles, extent, number and about how many distinct values per signal
    and ``group`` from stored sketches: no value is read again."""
    merged = sketches.groupBy(*(group or []), "signal").agg(
        F.sum("n").alias("n"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.kll_merge_agg_double("kll").alias("_kll"), F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("n_distinct"))
    for p in probs:
        merged = merged.withColumn(f"q{int(round(p * 100)):02d}", F.kll_sketch_get_quantile_double("_kll", F.lit(float(p))))
    return merged.drop("_kll")


def distinct_values(df: DataFrame, cols: list[str]) -> DataFrame:
    """The distinct value combinations of ``cols``."""
    return df.select(*cols).distinct()


def recorded_hours(meta: DataFrame) -> DataFrame:
    """Total recorded time: sum(last - first) over rows where both times
    are present and the parquet file name is non-empty; in seconds and hours."""
    present = lambda c: F.col(c).isNotNull() & ~F.isnan(c)  # noqa: E731 - pandas notna
    ok = (present("first_ptp_time") & present("last_ptp_time")
          & F.coalesce(F.col("filename_parquet") != "", F.lit(False)))
    total = F.sum(F.when(ok, F.col("last_ptp_time") - F.col("first_ptp_time")))
    return meta.agg(F.coalesce(total, F.lit(0.0)).alias("total_seconds")) \
        .withColumn("hours", F.col("total_seconds") / 3600)


def interval_hours(intervals: DataFrame, start: str = "start_time", end: str = "end_time") -> DataFrame:
    """Total interval time (e.g. highway time) in seconds and hours."""
    return (intervals.agg(F.coalesce(F.sum(F.col(end) - F.col(start)), F.lit(0.0)).alias("total_seconds"))
            .withColumn("hours", F.col("total_seconds") / 3600))


def signal_histogram(df: DataFrame, col: str, bins: int) -> DataFrame:
    """Equal-width histogram over [min, max] with ``bins`` bins, the last
    bin closed.  Returns the non-empty bins (bin, lower edge, upper edge,
    count).  The extent is a scalar subquery over the same column."""
    ext = one_row(df.agg(F.min(known(df, col)).alias("lo"), F.max(known(df, col)).alias("hi")))
    lo, hi = ext["lo"], ext["hi"]
    width = hi - lo
    v = F.col(col)
    idx = F.when(width == 0, F.lit(0)).otherwise(
        F.least(F.floor((v - lo) * bins / width), F.lit(bins - 1))).cast("int")
    h = df.where(v.isNotNull() & ~F.isnan(v)).groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return h.select("bin", (lo + width * F.col("bin") / bins).alias("bin_lo"),
                    (lo + width * (F.col("bin") + 1) / bins).alias("bin_hi"), "count")


def signal_density(df: DataFrame, col: str, gridsize: int = 200, cut: float = 3.0) -> DataFrame:
    """A10: Gaussian kernel density (NaN and null dropped) with Scott's bandwidth
    (std * n^(-1/5)) on ``gridsize`` points from min - cut*bw to max + cut*bw.
    Fewer than two values, or values that are all the same, have no bandwidth
    and give no rows.

    The grid is cut into blocks of ``GRID_BLOCK`` points.  Each value makes one
    row per block that has a point within ``REACH`` bandwidths of it; what the
    others would add is below n * phi(REACH) / (n * bw) = 1.1e-18 / bw in all.
    With u the distance to a block's first point and d the step, both in
    bandwidths, the kernel at point k is exp(-u*u/2) * exp(-u*d)^k *
    exp(-k*k*d*d/2): two exponentials a row instead of one a point, and the last
    factor enters once at the end.  The partial aggregation takes the rows up in
    the same task, so only one row of sums per task and block is shuffled."""
    v = (df.select(F.col(col).cast("double").alias("v"))
         .where(F.col("v").isNotNull() & ~F.isnan("v")))
    mom = one_row(v.agg(F.count(F.lit(1)).alias("n"), F.stddev_samp("v").alias("sd"),
                        F.min("v").alias("lo"), F.max("v").alias("hi")))
    n, bw = mom["n"], mom["sd"] * F.pow(mom["n"].cast("double"), F.lit(-0.2))
    lo, hi = mom["lo"] - bw * cut, mom["hi"] + bw * cut
    step = (hi - lo) / (gridsize - 1)
    blocks = -(-gridsize // GRID_BLOCK)
    rows = v.where(mom["sd"] > 0).select(((F.col("v") - lo) / bw).alias("at"), (step / bw).alias("d"))
    width = F.col("d") * GRID_BLOCK
    first = F.greatest(F.lit(0), F.floor((F.col("at") - REACH) / width))
    last = F.least(F.lit(blocks - 1), F.floor((F.col("at") + REACH) / width))
    rows = rows.select("at", "d", F.explode(F.sequence(first, last)).alias("block"))
    u = F.col("block") * F.col("d") * GRID_BLOCK - F.col("at")
    rows = rows.select("block", F.exp(u * u * -0.5).alias("a"), F.exp(u * F.col("d") * -1.0).alias("b"))

    def power(k: int) -> Column:
        out = F.col("a")
        for _ in range(k):
            out = out * F.col("b")
        return out
    sums = rows.groupBy("block").agg(F.array(*[F.sum(power(k)) for k in range(GRID_BLOCK)]).alias("s"))
    dens = sums.select("block", F.posexplode("s").alias("k", "_s")).select((F.col("block") * GRID_BLOCK + F.col("k")).alias("g"), "k", "_s")
    every = df.sparkSession.range(gridsize).where(mom["sd"] > 0).withColumnRenamed("id", "g")  # points no value is near have 0
    d = step / bw
    told = F.coalesce(F.col("_s") * F.exp(F.col("k") * F.col("k") * d * d * -0.5), F.lit(0.0))
    return every.join(F.broadcast(dens), "g", "left").select(
        F.col("g").cast("int").alias("g"), (lo + (hi - lo) * F.col("g") / (gridsize - 1)).alias("x"),
        (told / math.sqrt(2 * math.pi) / (bw * n)).alias("density"))


def exact_median(df: DataFrame, col: str, accuracy: int = 100_000, parts: int = 200) -> Column:
    """Exact median of ``col`` (mean of the two middle values for an even
    count, nulls and NaN ignored, as pandas does) as a scalar-subquery
    Column, without holding all values in one task.

    Count and a quantile sketch bracket the middle ranks: [q(0.5 -
    2/accuracy), q(0.5 + 2/accuracy)] contains them because the sketch's rank
    error is at most n/accuracy.  Values inside the bracket (about 4n/accuracy
    and the copies of its ends) are counted per value, so many copies of one
    value are one row; the distinct ones are cut into ``parts`` ranges of about
    equal size.  A range's first rank is the count of values below the bracket
    plus the totals of the ranges before it (at most ``parts`` numbers); inside
    a range ranks are a running sum.  If the bracket missed (it cannot, within
    the sketch guarantee) the query fails instead of answering."""
    v = (df.select(F.col(col).cast("double").alias("v"))
         .where(F.col("v").isNotNull() & ~F.isnan("v")))
    d = 2.0 / accuracy
    st = one_row(v.agg(F.count(F.lit(1)).alias("n"),
                       F.percentile_approx("v", [max(0.0, 0.5 - d), min(1.0, 0.5 + d)], accuracy).alias("b")))
    n, lo, hi = st["n"], st["b"][0], st["b"][1]
    below = v.where(F.col("v") < lo).agg(F.count(F.lit(1))).scalar()
    k1 = F.floor((n - 1) / 2)
    k2 = F.ceil((n - 1) / 2)
    per = v.where((F.col("v") >= lo) & (F.col("v") <= hi)).groupBy("v").agg(F.count(F.lit(1)).alias("c"))
    cuts = one_row(per.agg(F.percentile_approx("v", [k / parts for k in range(1, parts)], 50 * parts).alias("e")))["e"]
    per = (per.withColumn("cuts", cuts)
           .select("v", "c", F.size(F.filter("cuts", lambda e: e < F.col("v"))).alias("part")))
    totals = per.groupBy("part").agg(F.sum("c").alias("t"))
    totals = one_row(totals.agg(F.collect_list(F.struct("part", "t")).alias("p")))["p"]
    before = F.aggregate(F.filter("totals", lambda e: e["part"] < F.col("part")), F.lit(0).cast("long"),
                         lambda a, e: a + e["t"])
    w = Window.partitionBy("part").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (per.withColumn("run", F.sum("c").over(w)).withColumn("totals", totals)
              .select("v", "c", (below + before + F.col("run")).alias("upto")))

    def holds(k: Column) -> Column:
        return ((k < F.col("upto")) & (k >= F.col("upto") - F.col("c"))).cast("int")
    times = ranked.select("v", (holds(k1) + holds(k2)).alias("times")).where("times > 0")
    picked = times.agg((F.sum(F.col("v") * F.col("times")) / 2).alias("m"), F.sum("times").alias("c"))
    ok = (F.col("c") == 2) | (n == 0)
    return picked.select(F.when(ok, F.col("m")).otherwise(
        F.raise_error(F.lit("median bracket missed the middle ranks")))).scalar()


def median_centre(df: DataFrame, lat: str = "etrs89_latitude", lon: str = "etrs89_longitude",
                  rel_error: float | None = None) -> DataFrame:
    """Map centre as (median latitude, median longitude).  Exact by
    default (two-pass selection, ``exact_median``); ``rel_error`` returns the
    sketch estimate instead."""
    if rel_error is None:
        one = df.agg(F.count(F.lit(1)).alias("_n"))
        return one.select(exact_median(df, lat).alias("centre_lat"),
                          exact_median(df, lon).alias("centre_lon"))
    acc = max(1, int(round(1.0 / rel_error)))
    return df.agg(F.percentile_approx(known(df, lat), 0.5, acc).alias("centre_lat"),
                  F.percentile_approx(known(df, lon), 0.5, acc).alias("centre_lon"))


def geo_density(df: DataFrame, cell: float = 0.1, lat: str = "etrs89_latitude",
                lon: str = "etrs89_longitude") -> DataFrame:
    """A11 re-aimed: the point list behind a heat map as counts per
    lat/lon grid cell (cell index = floor(coordinate / cell)); rows without
    both coordinates are in none."""
    placed = df.where(known(df, lat).isNotNull() & known(df, lon).isNotNull())
    return (placed.groupBy(F.floor(F.col(lat) / cell).alias("cell_lat"),
                       F.floor(F.col(lon) / cell).alias("cell_lon"))
            .agg(F.count(F.lit(1)).alias("count")))


def epoch_to_timestamp(c: str | Column) -> Column:
    """Epoch seconds to a timestamp (microsecond precision)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.timestamp_micros(F.round(col * 1_000_000).cast("long"))


def timestamp_to_epoch(c: str | Column) -> Column:
    """Timestamp back to epoch seconds (double)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.unix_micros(col) / F.lit(1_000_000.0)
