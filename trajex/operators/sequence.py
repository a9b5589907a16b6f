"""Window and sequence operators.

Groups are time series ordered by ``ptp_time``: a (recording, interval) for
the scans, a recording for the trajectory repairs.  No group ever goes to one
task as a whole; one algorithm serves groups of all sizes:

* rows are counted in cells (time buckets; where one holds too many rows,
  exact times, then the other order columns, then shares of equal rows), and
  running totals of the cells give every cell its first row number
  (``cells``, ``cell_offsets``);
* consecutive cells make chunks of a bounded number of rows; look-ahead and
  look-back rows are copied to the neighbouring chunk as whole cells
  (``chunk_rows``), so one shuffle by (group, chunk) numbers the rows and
  brings every neighbour along;
* running sums add a per-chunk prefix total;
* the yaw-return scan reads its chunks sorted by (group, chunk) and searches
  first hits with a vectorised numpy kernel over many groups at once.  The
  walk is sequential: a group's first chunk is entered at row 0, so it is
  walked at once; later chunks reduce to a transfer table (entry offset to
  exit offset), tables are stitched per group, and each such chunk is walked
  again from its known entry.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajex.operators.cover import cover, levels_of, place
from trajex.schema import (HEADING_LAG, POSITION_JUMP, WINDOW_HALF_WIDTH,
                           ScanParams)
from trajex.session import materialize, ship_package

# Rows per chunk for chunked windows and the chunked walk.
CHUNK_ROWS = 1 << 16
# Width (seconds) of the time buckets used to number rows.
NUMBER_BUCKET_SECONDS = 60.0
# Cell tables up to this many rows are broadcast.
CELL_BROADCAST_ROWS = 250_000


# --- numbering and chunking -------------------------------------------------------

def join_groups(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which a null key equals a null key; the keys of ``left``
    stay."""
    r = right.select(*(F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns))
    cond = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in keys]
    return left.join(r, cond, how).drop(*(f"_r_{c}" for c in keys))


def cells(df: DataFrame, group: list[str], order: list[str], limit: int,
          bucket_seconds: float = NUMBER_BUCKET_SECONDS) -> tuple[DataFrame, list[str], DataFrame, int]:
    """Rows of ``df`` with cell keys, the names of the keys, the written row
    counts of the cells, and the number of cells.  Cells follow each other in the order of their
    keys as their rows do in ``order`` (first column a time in seconds; null
    times first, NaN last).

    A cell is a time bucket of a group.  One with more than ``limit`` rows is
    split by exact time, a part of it that is still larger by the next order
    column, and rows equal in all of them by a hash, so that no cell is large
    whatever repeats."""
    t = F.col(order[0]).cast("double")
    nb = (F.when(t.isNull(), F.lit(-(1 << 62))).when(F.isnan(t), F.lit(1 << 62))
          .otherwise(F.floor(t / bucket_seconds)))
    d, keys = df.withColumn("_k0", nb.cast("long")), ["_k0"]

    def counted() -> DataFrame:
        return materialize(d.groupBy(*group, *keys).agg(F.count(F.lit(1)).alias("_cnt")), "cell_sizes")

    def told() -> tuple[int, int]:
        row = sizes.agg(F.count(F.lit(1)).alias("n"), F.max("_cnt").alias("most")).first()
        return row["n"], row["most"] or 0

    sizes = counted()
    number, most = told()
    for n, column in enumerate([*order, None], 1):
        if most <= limit:
            break
        heavy = sizes.where(F.col("_cnt") > limit)
        if column is None:
            # equal rows may stand in any order, but in the same one each time
            d = materialize(d.withColumn("_row", F.monotonically_increasing_id()), "equal_rows")
            value = F.pmod(F.xxhash64("_row"), F.ceil(F.col("_cnt") * 2 / limit).cast("long"))
        else:
            value = F.col(column)
        d = join_groups(d, heavy, [*group, *keys], "left")
        d = d.withColumn(f"_k{n}", F.when(F.col("_cnt").isNotNull(), value)).drop("_cnt", "_row")
        keys = [*keys, f"_k{n}"]
        sizes = counted()
        number, most = told()
    return d, keys, sizes, number


def cell_offsets(sizes: DataFrame, group: list[str], keys: list[str]) -> DataFrame:
    """The cells with ``_off``, the group's rows in earlier cells."""
    before = Window.partitionBy(*group).orderBy(*keys).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0).cast("long")))


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """Marked for broadcast if the counted bound on its rows is small."""
    return F.broadcast(df) if rows <= CELL_BROADCAST_ROWS else df


def number_rows(df: DataFrame, group: list[str], order: list[str], out: str = "_i",
                bucket_seconds: float = NUMBER_BUCKET_SECONDS, limit: int = CHUNK_ROWS) -> DataFrame:
    """0-based row number inside each group in ``order``.  Equivalent to
    ``row_number() - 1`` over the group, but the row-level window is
    partitioned by (group, cell); only the small table of cell sizes is
    scanned per group.  Null group values are a group like any other."""
    d, keys, sizes, number = cells(df, group, order, limit, bucket_seconds)
    offsets = cell_offsets(sizes, group, keys).drop("_cnt")
    wr = Window.partitionBy(*group, *keys).orderBy(*order)
    numbered = join_groups(d, small_side(offsets, number), [*group, *keys])
    return (numbered.withColumn(out, (F.col("_off") + F.row_number().over(wr) - 1).cast("long"))
            .drop(*keys, "_off"))


def chunk_copies(df: DataFrame, group: list[str], order: list[str], chunk: int, ahead: int = 0, behind: int = 0,
                 bucket_seconds: float = NUMBER_BUCKET_SECONDS) -> tuple[DataFrame, list[str]]:
    """Rows with the chunk ``_c`` of their group they are copied to (0, 1, ...
    in order), ``_own`` on the original copy and ``_base``, the row number of
    the chunk's first copy; and the columns that order a chunk's copies.

    A chunk is a run of cells from about ``chunk`` rows.  Cells that start less
    than ``ahead`` rows after a chunk's end, or end less than ``behind`` rows
    before its start, are copied to it."""
    d, keys, sizes, cell_count = cells(df, group, order, max(1, chunk // 2), bucket_seconds)
    in_order = Window.partitionBy(*group).orderBy("_off")
    table = cell_offsets(sizes, group, keys).withColumn("_end", F.col("_off") + F.col("_cnt"))
    number = F.floor(F.col("_off") / chunk)
    first = F.coalesce(number != F.lag(number).over(in_order), F.lit(True))
    table = table.withColumn("_first", first.cast("int"))
    table = table.withColumn("_own_c", F.sum("_first").over(in_order) - 1)
    copies = F.array(F.col("_own_c"))
    if ahead > 0:  # to the chunks that end where a chunk starts just before or at this cell
        started = F.collect_list(F.when((F.col("_first") == 1) & (F.col("_own_c") > 0), F.col("_own_c") - 1))
        copies = F.concat(copies, started.over(in_order.rangeBetween(-(ahead - 1), 0)))
    if behind > 0:  # to the chunks that start just after or at this cell's end
        table = table.withColumn("_next", F.when(F.lead("_first").over(in_order) == 1, F.col("_own_c") + 1))
        by_end = Window.partitionBy(*group).orderBy("_end").rangeBetween(0, behind - 1)
        copies = F.concat(copies, F.collect_list("_next").over(by_end))
    table = (table.withColumn("_to", copies).withColumn("_c", F.explode("_to")).withColumn("_own", F.col("_c") == F.col("_own_c"))
             .withColumn("_base", F.min("_off").over(Window.partitionBy(*group, "_c"))))
    plan = table.select(*group, *keys, "_c", "_own", "_base")
    # a cell goes to its own chunk and, as chunks are longer than halos, to one on either side
    return join_groups(d, small_side(plan, 3 * cell_count), [*group, *keys]), [*keys, *order]


def chunk_rows(df: DataFrame, group: list[str], order: list[str], chunk: int, ahead: int = 0, behind: int = 0,
               bucket_seconds: float = NUMBER_BUCKET_SECONDS) -> DataFrame:
    """``chunk_copies`` with ``_i``, the row number in the group.  A window
    partitioned by (group, ``_c``) sees every neighbour within the halo; rows
    cross the network once."""
    h, by = chunk_copies(df, group, order, chunk, ahead, behind, bucket_seconds)
    w = Window.partitionBy(*group, "_c").orderBy(*by)
    return (h.withColumn("_i", (F.col("_base") + F.row_number().over(w) - 1).cast("long"))
            .drop("_base", *(k for k in by if k not in order)))


def chunked(df: DataFrame, idx: str, chunk: int, ahead: int = 0, behind: int = 0) -> DataFrame:
    """For rows that carry their row number: assign rows to chunks of ``chunk``
    row numbers (column ``_c``) and copy halo rows: the first ``ahead`` rows of a chunk also go to the previous
    chunk, the last ``behind`` rows also to the next.  ``_own`` marks the
    original copy.  A window partitioned by (group, ``_c``) then sees every
    neighbour within the halo.  One pass: each row explodes into its chunk
    ids."""
    i = F.col(idx)
    c = F.floor(i / chunk)
    r = i % chunk
    none = F.array().cast("array<bigint>")
    ids = F.array(c)
    if ahead:
        ids = F.concat(ids, F.when((r < ahead) & (i >= chunk), F.array(c - 1)).otherwise(none))
    if behind:
        ids = F.concat(ids, F.when(r >= chunk - behind, F.array(c + 1)).otherwise(none))
    return df.withColumn("_c", F.explode(ids)).withColumn("_own", F.col("_c") == c)


# --- yaw-return scan (W1, W3, W5) ---------------------------------------------------

# Rows per block of the vectorised first-hit search (bounds task memory to
# a few blocks x maximum doubles).
HIT_BLOCK_ROWS = 4096


def first_hits(v: np.ndarray, at: np.ndarray, odd_row: np.ndarray, p: ScanParams) -> np.ndarray:
    """For the rows at the places ``at`` of ``v`` the offset k of the first
    j = i + k, 1 <= k <= maximum, with |v[j] - v[i]| <= tol and
    lo < |v[m] - v[i]| < hi, where m = round-half-even((i + j) / 2); 0 when
    there is none.  ``odd_row`` tells whether i is odd, which decides how a
    half is rounded: m - i = k//2 + (k%2)*((i + k//2)%2).  At least ``maximum``
    values follow each place; NaN stands behind a group's end and compares
    false, as in Python."""
    ks = np.arange(1, p.maximum + 1)
    half, odd = ks // 2, ks % 2
    win = np.lib.stride_tricks.sliding_window_view(v, p.maximum + 1)
    out = np.zeros(len(at), dtype=np.int64)
    for parity in (0, 1):
        rows = np.flatnonzero(odd_row == bool(parity))
        middle = half + odd * ((parity + half) % 2)
        for b0 in range(0, len(rows), HIT_BLOCK_ROWS):
            r = rows[b0:b0 + HIT_BLOCK_ROWS]
            w = win[at[r]] - v[at[r]][:, None]
            np.abs(w, out=w)
            with np.errstate(invalid="ignore"):
                cond = w[:, 1:] <= p.tol
                # most rows have no such j close by: only the others need their middles
                some = np.flatnonzero(cond.any(axis=1))
                dev, cond = w[some][:, middle], cond[some]
                cond &= dev > p.lo
                if p.hi is not None:
                    cond &= dev < p.hi
            out[r[some]] = np.where(cond.any(axis=1), cond.argmax(axis=1) + 1, 0)
    return out


def _steps(k: np.ndarray, p: ScanParams) -> tuple[np.ndarray, np.ndarray]:
    emit = k >= p.minimum
    return np.where(emit, p.jump, 2), emit


def _walk(hpos: np.ndarray, step: np.ndarray, start: int, end: int) -> list[int]:
    """Indices of the hit rows the walk visits when it enters at ``start``
    and leaves at ``end`` (rows between hits advance by one)."""
    seen, q = [], start
    while q < end:
        j = int(np.searchsorted(hpos, q))
        if j >= len(hpos):
            break
        seen.append(j)
        q = int(hpos[j] + step[j])
    return seen


def _same_as_before(column: pa.Array) -> np.ndarray:
    """Whether each value but the first equals the one before it; nulls equal
    nulls and NaN equals NaN."""
    a, b = column.slice(0, len(column) - 1), column.slice(1)
    same = pc.fill_null(pc.equal(a, b), False)
    both = pc.and_(pc.is_null(a, nan_is_null=True), pc.is_null(b, nan_is_null=True))
    nulls = pc.equal(pc.is_null(a), pc.is_null(b))  # a null is not a NaN
    return pc.or_(same, pc.and_(both, nulls)).to_numpy(zero_copy_only=False)


def run_starts(table: pa.Table, columns: list[str]) -> np.ndarray:
    """The places at which a row differs in ``columns`` from the row before."""
    if not table.num_rows:
        return np.empty(0, np.int64)
    same = np.ones(table.num_rows - 1, bool)
    for c in columns:
        same &= _same_as_before(table.column(c).combine_chunks())
    return np.concatenate([[0], np.flatnonzero(~same) + 1])


# Rows that a scanning task gathers before it searches them.
SCAN_BLOCK_ROWS = 1 << 16
#: Kinds of rows that the scan of chunks gives.
PAIR, HIT, TABLE = 0, 1, 2


def scan_runs(table: pa.Table, starts: np.ndarray, gcols: list[str], value: str, time_col: str, p: ScanParams) -> pa.Table:
    """Scans the (group, chunk) runs of ``table`` that begin at ``starts``,
    each with its own rows first and its look-ahead rows after them.

    First chunks (``_c`` 0) give their accepted pairs and, if a chunk follows,
    their exit; later chunks give their hit rows and a transfer table, the
    exit for every entry offset."""
    n, runs = table.num_rows, len(starts)
    sizes = np.diff(np.append(starts, n))
    run = np.repeat(np.arange(runs), sizes)
    own = table.column("_own").to_numpy()
    v = table.column(value).to_numpy()
    t = table.column(time_col).to_numpy()
    c, base = (table.column(k).to_numpy()[starts] for k in ("_c", "_base"))
    owned = np.add.reduceat(own.astype(np.int64), starts)
    ends = starts + owned
    # NaN between the runs keeps each look-ahead inside its run
    spread = np.arange(n) + run * p.maximum
    padded = np.full(n + runs * p.maximum, np.nan)
    padded[spread] = v
    number = base[run] + np.arange(n) - starts[run]
    rows = np.flatnonzero(own)
    k = first_hits(padded, spread[rows], number[rows] % 2 == 1, p)
    hit = rows[k > 0]
    k = k[k > 0]
    step, emit = _steps(k, p)
    of_run = run[hit]
    over = hit + step - ends[of_run]  # how far past its run's end a hit row's step leads
    first = np.searchsorted(hit, np.append(starts, n))
    nxt, leaves, last = np.searchsorted(hit, hit + step).tolist(), over.tolist(), first[1:].tolist()
    pairs, exits, tables = [], [], []
    for r in range(runs):
        stop = last[r]
        if c[r] == 0:
            j, out = int(first[r]), 0
            while j < stop:
                if emit[j]:
                    pairs.append(j)
                if leaves[j] >= 0:
                    out = leaves[j]
                    break
                j = nxt[j]
            if sizes[r] > owned[r]:
                exits.append([out])
                tables.append(r)
        else:
            leave = {}
            for j in range(stop - 1, int(first[r]) - 1, -1):
                leave[j] = leaves[j] if leaves[j] >= 0 else leave.get(nxt[j], 0)
            entered = np.searchsorted(hit, starts[r] + np.arange(max(p.jump, 2))).tolist()
            exits.append([leave.get(j, 0) for j in entered])
            tables.append(r)
    later = np.flatnonzero(c[of_run] > 0)
    chosen = np.concatenate([np.array(pairs, np.int64), later])
    tables = np.array(tables, np.int64)
    at = np.concatenate([hit[chosen], starts[tables]])
    pad = np.zeros(len(tables), np.int64)
    kind = np.concatenate([np.full(len(pairs), PAIR), np.full(len(later), HIT), np.full(len(tables), TABLE)])
    out = {g: table.column(g).take(pa.array(at)) for g in gcols}
    out |= {"_c": c[run[at]], "_i": number[at], "_k": np.concatenate([k[chosen], owned[tables]]), "_step": np.concatenate([step[chosen], pad]),
            "_emit": np.concatenate([emit[chosen], pad.astype(bool)]), "t_i": t[at], "t_j": t[at + np.concatenate([k[chosen], pad])],
            "_exits": pa.array([None] * len(chosen) + exits, pa.list_(pa.int64())), "_kind": kind}
    return pa.table(out)


def _scan_fn(p: ScanParams, gcols: list[str], value: str, time_col: str):
    """Over sorted batches: whole (group, chunk) runs are gathered up to
    ``SCAN_BLOCK_ROWS`` rows (or one longer run) and scanned together."""
    def scan(batches):
        held, rows = [], 0

        def flush(final: bool):
            nonlocal held, rows
            table = pa.Table.from_batches(held)
            starts = run_starts(table, [*gcols, "_c"])
            cut = table.num_rows if final else int(starts[-1])  # the last run may go on
            if cut:
                done = scan_runs(table.slice(0, cut), starts if final else starts[:-1], gcols, value, time_col, p)
                yield from done.combine_chunks().to_batches()
            rest = table.slice(cut)
            held, rows = rest.to_batches(), rest.num_rows

        limit = SCAN_BLOCK_ROWS
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= limit:
                yield from flush(False)
                limit = max(SCAN_BLOCK_ROWS, 2 * rows)  # a long run is not looked through again and again
        if rows:
            yield from flush(True)
    return scan


def _stitch_fn(gcols: list[str]):
    """From the tables of a group's chunks, in order, the row at which the walk
    enters each chunk and the chunk's end."""
    def stitch(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("_c")
        entries, leave = [], 0
        for start, exits in zip(pdf["_i"].to_numpy(np.int64), pdf["_exits"]):
            entries.append(start + leave)
            leave = int(exits[leave] if len(exits) > 1 else exits[0])  # a first chunk has the exit of entry 0 only
        out = pdf[gcols + ["_c"]].copy()
        out["_entry"] = np.asarray(entries, dtype=np.int64)
        out["_end"] = pdf["_i"] + pdf["_k"]
        return out
    return stitch


def _walk_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("_i").reset_index(drop=True)
    seen = _walk(pdf["_i"].to_numpy(np.int64), pdf["_step"].to_numpy(np.int64), int(pdf["_entry"].iloc[0]), int(pdf["_end"].iloc[0]))
    emit = pdf["_emit"].to_numpy(bool)
    return pdf.loc[[j for j in seen if emit[j]]].drop(columns=["_entry", "_end", "_step", "_emit", "_c"])


def yaw_return_scan(df: DataFrame, group: list[str], params: ScanParams, *,
                    value: str = "Yaw", time_col: str = "ptp_time",
                    chunk: int = CHUNK_ROWS) -> DataFrame:
    """W1 (and W3, W5 with other parameters or column): the pairs (t_i, t_j)
    the greedy scan accepts in each group.  Output columns: group columns,
    ``i`` and ``j`` (row numbers), ``t_i``, ``t_j``.

    Rows go once to their (group, chunk), with a halo of ``maximum`` rows
    ahead, and are scanned in sorted order, many small groups at a time.  Pairs
    of first chunks are final; tables of later chunks are stitched per group
    and each later chunk is walked from its entry, so no task holds more than
    one chunk."""
    ship_package(df.sparkSession)
    chunk = max(chunk, 2 * params.maximum + 2, 2 * params.jump + 2)  # a chunk has at least half as many rows
    src = df.select(*group, F.col(time_col).cast("double").alias(time_col),
                    F.col(value).cast("double").alias(value))
    gfields = [f for f in src.schema.fields if f.name in group]
    gsql = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in gfields)
    h, by = chunk_copies(src, group, [time_col, value], chunk, ahead=params.maximum)
    out = T.StructType(gfields + [T.StructField(c, T.LongType()) for c in ("_c", "_i", "_k", "_step")] + [
        T.StructField("_emit", T.BooleanType()), T.StructField("t_i", T.DoubleType()), T.StructField("t_j", T.DoubleType()),
        T.StructField("_exits", T.ArrayType(T.LongType())), T.StructField("_kind", T.LongType())])
    gnames = [f.name for f in gfields]
    dealt = h.repartition(*group, "_c").sortWithinPartitions(*group, "_c", *by)
    scanned = dealt.select(*gnames, "_c", "_own", "_base", time_col, value).mapInArrow(
        _scan_fn(params, gnames, value, time_col), out)
    # pairs, hit rows and tables are read apart: write once
    per_chunk = materialize(scanned, "scan_hits")
    pairs = [*group, F.col("_i").alias("i"), (F.col("_i") + F.col("_k")).alias("j"), "t_i", "t_j"]
    done = per_chunk.where(F.col("_kind") == PAIR).select(*pairs)
    tables = per_chunk.where(F.col("_kind") == TABLE)
    if tables.isEmpty():  # no group has a second chunk
        return done
    entries = (tables.select(*group, "_c", "_i", "_k", "_exits").groupBy(*group)
               .applyInPandas(_stitch_fn(group), f"{gsql}, _c long, _entry long, _end long"))
    hits = per_chunk.where(F.col("_kind") == HIT).drop("_exits", "_kind")
    walked = join_groups(hits, entries, [*group, "_c"]).groupBy(*group, "_c").applyInPandas(
        _walk_chunk, f"{gsql}, _i long, _k long, t_i double, t_j double")
    return done.unionByName(walked.select(*pairs))


def lane_change_windows(pairs: DataFrame, half_width: float = WINDOW_HALF_WIDTH) -> DataFrame:
    """Window around the middle of each pair,
    (0.5*t_i - 6 + 0.5*t_j, 0.5*t_i + 6 + 0.5*t_j)."""
    return (pairs.withColumn("lc_start", F.col("t_i") * 0.5 - half_width + F.col("t_j") * 0.5)
            .withColumn("lc_end", F.col("t_i") * 0.5 + half_width + F.col("t_j") * 0.5))


def containment_anti(short: DataFrame, long: DataFrame, group: list[str],
                     start: str = "t_i", end: str = "t_j", long_start: str = "t_i",
                     long_end: str = "t_j", bucket: float = 60.0) -> DataFrame:
    """Drop short windows (start <= end) that lie inside a long window of
    the same group (b0 <= a0 and b1 >= a1).  Never adds rows; a window with a
    null time or group stays.

    Of long windows with one start only the longest counts.  They are covered
    by dyadic cells, so the join is an equi-join on (group, level, cell) of the
    short window's start with the range as a residual; a hot group is spread
    over many keys."""
    b = long.groupBy(*group, F.col(long_start).alias("_b0")).agg(F.max(long_end).alias("_b1"))
    b = cover(b, "_b0", "_b1", bucket)
    out = short
    for level in levels_of(b):  # one to three in general: what one level drops the next ones need not see
        s = out.withColumn("_b", place(F.col(start), level, bucket)).alias("s")
        at = b.where(F.col("_lv") == level).alias("b")
        cond = [F.col(f"s.{k}") == F.col(f"b.{k}") for k in [*group, "_b"]]
        cond += [F.col("b._b0") <= F.col(f"s.{start}"), F.col("b._b1") >= F.col(f"s.{end}")]
        out = s.join(at, cond, "left_anti").drop("_b")
    return out


# --- trajectory repair (W6, W7) ------------------------------------------------------

def _chunk_prefix(df: DataFrame, group: list[str], cols: list[str]) -> DataFrame:
    """Per (group, chunk): the sum of ``cols`` over all earlier chunks."""
    tot = df.where("_own").groupBy(*group, "_c").agg(*[F.sum(c).alias(c) for c in cols])
    w = Window.partitionBy(*group).orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)
    return tot.select(*group, "_c", *[F.coalesce(F.sum(c).over(w), F.lit(0.0)).alias(f"_pre_{c}")
                                      for c in cols])


def position_stitch(df: DataFrame, group: list[str], *, jump: float = POSITION_JUMP,
                    time_col: str = "ptp_time", chunk: int = CHUNK_ROWS) -> DataFrame:
    """Where X or Y moves more than ``jump`` between consecutive original
    rows (row k, k >= 2), add 1.5*P[k-1] - 0.5*P[k-2] to X, Y and Z of row k
    and every later row of the group; offsets add up.  Row 1 has no k-2 and
    gets no offset.

    As in a comparison of numbers, a move that is NaN or null is no jump; an
    offset from a NaN or null position is NaN.  Chunks with a two-row halo plus
    chunk prefix sums."""
    chunk = max(chunk, 3)
    # equal times are ordered by position, so reruns number rows alike
    order = [time_col, "PositionX", "PositionY", "PositionZ"]
    h = chunk_rows(df, group, order, chunk, behind=2)
    w = Window.partitionBy(*group, "_c").orderBy("_i")

    def moved(c: str) -> Column:
        by = F.abs(F.col(c) - F.lag(c, 1).over(w))
        return F.coalesce((by > jump) & ~F.isnan(by), F.lit(False))
    h = h.withColumn("_jump", (moved("PositionX") | moved("PositionY")) & (F.col("_i") >= 2))
    for axis, d in (("X", "_dx"), ("Y", "_dy"), ("Z", "_dz")):
        c = f"Position{axis}"
        offset = F.lag(c, 1).over(w) * 1.5 - F.lag(c, 2).over(w) * 0.5
        h = h.withColumn(d, F.when(F.col("_jump"), F.coalesce(offset, F.lit(float("nan")))).otherwise(0.0))
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    h = h.where("_own")
    for d in ("_dx", "_dy", "_dz"):
        h = h.withColumn(f"_run{d}", F.sum(d).over(run))
    # two passes (chunk totals, then rows): write the row-level result once
    h = materialize(h, "stitch_rows")
    pre = _chunk_prefix(h, group, ["_dx", "_dy", "_dz"])
    out = join_groups(h, pre, [*group, "_c"], "left")
    for axis, d in (("X", "_dx"), ("Y", "_dy"), ("Z", "_dz")):
        out = out.withColumn(f"Position{axis}", F.col(f"Position{axis}")
                             + F.coalesce(F.col(f"_pre_{d}"), F.lit(0.0)) + F.col(f"_run{d}"))
    return out.drop("_c", "_own", "_dx", "_dy", "_dz", "_run_dx", "_run_dy", "_run_dz",
                    "_pre__dx", "_pre__dy", "_pre__dz").withColumnRenamed("_i", "row_no")


def heading(df: DataFrame, group: list[str], *, lag: int = HEADING_LAG,
            time_col: str = "ptp_time", chunk: int = CHUNK_ROWS, idx: str | None = None) -> DataFrame:
    """``angle = atan2(y - y[i-lag], x - x[i-lag])``; the first ``lag``
    rows take row ``lag``'s angle; groups of ``lag`` rows or fewer get null.

    Both steps are windows over the same (group, chunk) partitioning and
    order, so they run in one stage: the second reads row ``lag``'s angle
    from a frame of ``lag`` rows ahead (rows 0..lag are always in chunk 0)."""
    chunk = max(chunk, lag + 1)
    i = idx or "_i"
    order = [time_col, "PositionX", "PositionY"]
    h = chunked(df, i, chunk, behind=lag) if idx else chunk_rows(df, group, order, 2 * chunk, behind=lag)
    w = Window.partitionBy(*group, "_c").orderBy(i)
    ang = F.atan2(F.col("PositionY") - F.lag("PositionY", lag).over(w),
                  F.col("PositionX") - F.lag("PositionX", lag).over(w))
    h = h.withColumn("angle", F.when(F.col(i) >= lag, ang))
    ahead = F.collect_list(F.struct(F.col(i).alias("k"), F.col("angle").alias("a"))).over(
        w.rowsBetween(0, lag))
    at_lag = F.filter(ahead, lambda e: e["k"] == lag)
    out = (h.withColumn("angle", F.when(F.col(i) < lag, F.try_element_at(at_lag, F.lit(1))["a"])
                        .otherwise(F.col("angle")))
           .where("_own").drop("_c", "_own"))
    return out if idx else out.withColumnRenamed("_i", "row_no")


def trajectory_process(df: DataFrame, group: list[str], chunk: int = CHUNK_ROWS, **kw) -> DataFrame:
    """W6 then W7 (``sample_process``)."""
    return heading(position_stitch(df, group, chunk=chunk, **kw), group, idx="row_no", chunk=chunk, **kw)


# --- polylines and poses (W9, W10) ----------------------------------------------------

def polyline_merge(lines: DataFrame, scene: list[str], seq: str = "line_seq",
                   track: str = "TrackingID") -> DataFrame:
    """At one scene time, neighbouring lines (in ``seq`` order) with the
    same TrackingID are merged by appending their point arrays.  Gaps and
    islands: a new run starts where the TrackingID changes."""
    w = Window.partitionBy(*scene).orderBy(seq)
    runs = (lines.withColumn("_new", F.coalesce(F.lag(track).over(w) != F.col(track), F.lit(True)))
            .withColumn("_run", F.sum(F.col("_new").cast("int")).over(
                w.rowsBetween(Window.unboundedPreceding, 0))))
    return (runs.groupBy(*scene, "_run").agg(
        F.first(track).alias(track), F.min(seq).alias(seq),
        F.array_sort(F.collect_list(F.struct(F.col(seq).alias("s"), F.col("BoundaryLineX").alias("x"),
                                             F.col("BoundaryLineY").alias("y")))).alias("_parts"))
        .select(*scene, F.col("_run").alias("run_no"), track, seq,
                F.flatten(F.transform("_parts", lambda p: p["x"])).alias("BoundaryLineX"),
                F.flatten(F.transform("_parts", lambda p: p["y"])).alias("BoundaryLineY")))


def pose_recentre(df: DataFrame, ref_times: DataFrame, *, time_col: str = "ptp_time",
                  tol: float = 0.05) -> DataFrame:
    """Subtract the pose at a reference time from every position of the
    recording.  ``ref_times`` has (recording_id, ref_time); the reference
    pose is the row within ``tol`` of the reference time (the earliest such row
    when several qualify, of equal times the one with the smallest position).
    Rows of a recording without a reference pose stay, with null adjusted
    positions."""
    cand = (df.alias("d").join(ref_times.alias("r"), "recording_id")
            .where(F.abs(F.col(f"d.{time_col}") - F.col("r.ref_time")) < tol))
    ref = (cand.groupBy("recording_id")
           .agg(F.min(F.struct(F.col(f"d.{time_col}").alias("t"), F.col("PositionX").alias("x"),
                               F.col("PositionY").alias("y"))).alias("_ref"))
           .select("recording_id", F.col("_ref.x").alias("_rx"), F.col("_ref.y").alias("_ry")))
    return (df.join(ref, "recording_id", "left")
            .withColumn("AdjustedPositionX", F.col("PositionX") - F.col("_rx"))
            .withColumn("AdjustedPositionY", F.col("PositionY") - F.col("_ry"))
            .drop("_rx", "_ry"))
