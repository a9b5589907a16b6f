"""Shards of near equal bytes by a k-d tree over document metadata.

Points of the tree are texts: all rows with an equal text are one point, with
their bytes as its weight and as coordinates the size (by doublings), and the
smallest value in the group of every metadata column asked for.  A node that
stands for several shards is split along its widest dimension at the weighted
median, or where the shares of its shards meet if their number is odd, until a
leaf is one shard, that is, has the target bytes (all bytes over the shards).

Weighted medians are found for all nodes of a level at once by counting: bytes
per cell of each dimension give the widths and the cell that holds the median;
among the points of that cell a hash of the text is the order, and two more
counts of 4,096 cells each narrow it down.  A count is one aggregation with at
most nodes * dimensions * 4,096 groups; what comes to the driver is one row a
node and dimension.  The point at the median goes to the side that leaves the smaller error.

A text whose rows hold more than ``WHOLE`` of the target is dealt by row into
parts of at most that size, neighbours in every order of the tree, so a cut
goes through a large group only where it lies on the border; all other groups
of equal texts stay in one shard.  At most shards / ``WHOLE`` texts can be that
large, which bounds the table that tasks get of them.

Null texts count as empty, null metadata has a place of its own before all
values, NaN is null.  Null ids and repeated rows are rows like others.  Empty
tables give empty results; with fewer points than shards some shards are empty.
A row takes place ``slot`` of its shard by numbers inside 1,024 parts of each
shard and the sizes of the parts before, so no task orders a whole shard.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajex.llm.common import row_key, safe_names, small_join, stage, table, whole_rows

#: Shards, bytes a row costs beside its text, and the share of a shard up to
#: which equal texts are never parted.
SHARDS, ROW_BYTES, WHOLE = 40, 16, 0.02
#: Cells of a dimension and of a step through the hash, in bits; the steps.
CELL_BITS, STEPS = 12, 2
CELLS, HASH_BITS = 1 << CELL_BITS, CELL_BITS * STEPS
#: Parts of a shard inside which rows are numbered, and levels of the tree
#: between two writes of the points.
PARTS, LEVELS = 1024, 6


def number(column: Column, kind: T.DataType) -> Column:
    """A metadata value as a double in the value's order: numbers as they are,
    all else by the first six bytes of its text."""
    if isinstance(kind, (T.NumericType, T.BooleanType)):
        value = column.cast("double")
        return F.when(~F.isnan(value), value)
    return F.conv(F.rpad(F.substring(F.hex(column.cast("string").cast("binary")), 1, 12), 12, "0"), 16, 10).cast("double")


def sized_rows(df: DataFrame, id_column: str, column: str, dimensions: list[str], key: Column | None) -> DataFrame:
    """id, row, key, size, text_crc32, digest and one coordinate m0, m1, ...
    for the size and each dimension; written, as every later step starts here."""
    text = F.coalesce(F.col(f"`{column}`").cast("string"), F.lit("")).cast("binary")
    size = (F.octet_length(text) + ROW_BYTES).cast("long")
    coordinates = [F.log2(size.cast("double"))] + [number(F.col(f"`{d}`"), df.schema[d].dataType) for d in dimensions]
    return stage(df.select(
        F.col(f"`{id_column}`").alias("id"), F.monotonically_increasing_id().alias("row"),
        (key if key is not None else F.lit(None).cast("binary")).alias("key"), size.alias("size"), F.crc32(text).alias("text_crc32"),
        F.unhex(F.substring(F.sha2(text, 256), 1, 32)).alias("digest"), *(c.alias(f"m{k}") for k, c in enumerate(coordinates))), "sizes")


def points(rows: DataFrame, shards: int, whole: float = WHOLE) -> tuple[DataFrame, DataFrame]:
    """The rows with their ``part``, and the points (digest, part, weight, h,
    cells d0, d1, ... and the root as their ``node``)."""
    names = [c for c in rows.columns if c.startswith("m")]
    total = rows.agg(F.sum("size")).first()[0] or 0
    limit = max(1, int(whole * total / shards))
    groups = rows.groupBy("digest").agg(F.sum("size").alias("bytes"), *(F.min(m).alias(m) for m in names))
    # at most total / limit = shards / whole groups are that large
    large = stage(groups.filter(F.col("bytes") > limit).select("digest", F.ceil(F.col("bytes") / limit).alias("parts"), *(F.col(m).alias(f"g_{m}") for m in names)), "large-groups")
    dealt = rows.join(F.broadcast(large), "digest", "left").select(
        *(c for c in rows.columns if c not in names), F.coalesce(F.pmod(F.xxhash64("id", "row"), "parts"), F.lit(0)).alias("part"),
        *(F.when(F.col("parts").isNull(), F.col(m)).otherwise(F.col(f"g_{m}")).alias(m) for m in names))
    found = stage(dealt.groupBy("digest", "part").agg(F.sum("size").alias("weight"), *(F.min(m).alias(m) for m in names))
                  .withColumn("node", F.lit(0).cast("long")), "points")
    ends = found.agg(*(f(m).alias(f"{n}_{m}") for m in names for f, n in ((F.min, "lo"), (F.max, "hi")))).first()
    cells = []
    for k, m in enumerate(names):
        lo, hi = ends[f"lo_{m}"], ends[f"hi_{m}"]
        place = F.lit(0.0) if lo is None or hi == lo else (F.col(m) - lo) / (hi - lo) * (CELLS - 2)
        cells.append(F.when(F.col(m).isNull(), 0).otherwise(1 + F.floor(place)).cast("int").alias(f"d{k}"))
    h = F.pmod(F.shiftrightunsigned(F.xxhash64("digest"), 64 - HASH_BITS) + F.col("part"), F.lit(1 << HASH_BITS))
    return dealt.drop(*names), found.select("digest", "part", "weight", h.alias("h"), *cells, "node")


def told(spark: SparkSession, rows: list[tuple], names: str) -> DataFrame:
    """A few rows from the driver as a table to broadcast; no job reads it."""
    columns = list(zip(*rows, strict=True))
    return F.broadcast(spark.createDataFrame(pa.table(dict(zip(names.split(), columns, strict=True)))))


def first_reaching(counted: DataFrame, by: list[str]) -> DataFrame:
    """From counts (``by``, cell, bytes, goal, before) in each group the first
    ``cell`` at which ``before`` and the bytes of the cells up to it reach the
    ``goal``, with the bytes ``below`` and ``at`` it, and the ``width`` between
    the first and the last cell."""
    running = Window.partitionBy(*by).orderBy("cell")
    upto = counted.withColumn("upto", F.col("before") + F.sum("bytes").over(running))
    short = F.col("upto") < F.col("goal")  # of all cells only where rounding lifts the goal over the sum
    order = F.struct(short.alias("short"), F.when(short, -F.col("cell")).otherwise(F.col("cell")).alias("o"), "cell", "upto", "bytes")
    return upto.groupBy(*by).agg(F.min(order).alias("f"), (F.max("cell") - F.min("cell")).alias("width")).select(
        *by, "width", "f.cell", (F.col("f.upto") - F.col("f.bytes")).alias("below"), F.col("f.bytes").alias("at"))


def cuts(nodes: DataFrame, goals: dict[int, float]) -> dict[int, tuple]:
    """For every node to be split (``goals``: bytes its left side should have)
    its widest dimension ``dim`` and the cut: (dim, at, cut, take, bytes of the
    left side).  A point goes left if its (cell, hash) is below (at, cut), or
    equal to it and ``take``."""
    spark = nodes.sparkSession
    dims = dimensions_of(nodes)
    split = nodes.join(told(spark, list(goals.items()), "node goal"), "node")
    each = split.select("node", "goal", "weight", F.explode(F.array(*(F.struct(F.lit(k).alias("dim"), F.col(d).alias("cell")) for k, d in enumerate(dims)))).alias("e"))
    counted = each.groupBy("node", "goal", "e.dim", "e.cell").agg(F.sum("weight").alias("bytes")).withColumn("before", F.lit(0).cast("long"))
    widest = {}
    for r in first_reaching(counted, ["node", "dim"]).collect():  # a row a node and dimension
        widest[r["node"]] = max(widest.get(r["node"], (-1,)), (r["width"], -r["dim"], r["cell"], r["below"], r["at"]))
    held = {n: (-dim, cell, 0, below, at) for n, (_, dim, cell, below, at) in widest.items()}
    for step in range(STEPS):
        shift = HASH_BITS - CELL_BITS * (step + 1)
        now = told(spark, [(n, *held[n][:4], goals[n]) for n in held], "node dim place bits before goal")
        inside = nodes.join(now, "node").filter((F.array(*dims)[F.col("dim").cast("int")] == F.col("place")) & (F.shiftright("h", shift + CELL_BITS) == F.col("bits")))
        counted = inside.groupBy("node", "goal", "before", F.shiftright("h", shift).alias("cell")).agg(F.sum("weight").alias("bytes"))
        for r in first_reaching(counted, ["node"]).collect():  # a row a node
            held[r["node"]] = (*held[r["node"]][:2], r["cell"], r["below"], r["at"])
    out = {}
    for n, (dim, place, bits, below, at) in held.items():
        take = 2 * (goals[n] - below) > at  # the nearer side
        out[n] = (dim, place, bits, take, below + (at if take else 0))
    return out


def dimensions_of(found: DataFrame) -> list[str]:
    return [c for c in found.columns if c.startswith("d") and c[1:].isdigit()]


def tree(found: DataFrame, shards: int) -> DataFrame:
    """The points with their shard.  A node's name is its first shard, so the
    leaves are the shards; the driver holds shards and bytes of each node.
    Nodes follow from the cuts so far; they are written every few levels."""
    nodes, dims = found, dimensions_of(found)
    total = found.agg(F.sum("weight")).first()[0]
    held, level = {0: (shards, total)} if total else {}, 0
    while several := {n: bytes_ * (k // 2) / k for n, (k, bytes_) in held.items() if k > 1}:
        made = cuts(nodes, several)
        rows = [(n, *made[n][:4], n + held[n][0] // 2) for n in made]
        own = F.array(*dims)[F.col("dim").cast("int")]
        left = (own < F.col("at")) | ((own == F.col("at")) & ((F.col("h") < F.col("cut")) | ((F.col("h") == F.col("cut")) & F.col("take"))))
        nodes = nodes.join(told(found.sparkSession, rows, "node dim at cut take right"), "node", "left").withColumn(
            "node", F.when(F.col("dim").isNotNull() & ~left, F.col("right")).otherwise(F.col("node"))).select(*found.columns)
        for n, (_, _, _, _, below) in made.items():
            k, bytes_ = held[n]
            held[n], held[n + k // 2] = (k // 2, below), (k - k // 2, bytes_ - below)
        held, level = {n: x for n, x in held.items() if x[1]}, level + 1  # a side without points needs no cut
        nodes = stage(nodes, "nodes") if level % LEVELS == 0 else nodes
    return nodes.withColumnRenamed("node", "shard")


def numbered(rows: DataFrame) -> DataFrame:
    """Adds ``slot``: 0, 1, 2, ... without gaps in every shard."""
    order = Window.partitionBy("shard", "bucket")
    dealt = stage(rows.withColumn("bucket", F.pmod(F.xxhash64("id", "row"), F.lit(PARTS)).cast("int")), "sharded")
    sizes = dealt.groupBy("shard", "bucket").agg(F.count("*").alias("n"))  # at most shards * PARTS rows
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("shard", "bucket", F.coalesce(before, F.lit(0)).alias("start"))
    inside = dealt.withColumn("inside", F.row_number().over(order.orderBy("id", "row")) - 1)
    return small_join(inside, starts, ["shard", "bucket"], "inner").withColumn("slot", F.col("start") + F.col("inside")).drop("bucket", "inside", "start")


def assign(df: DataFrame, id_column: str = "doc_id", column: str = "text", dimensions: list[str] = ("lang", "source"), shards: int = SHARDS,
           whole: float = WHOLE, key: Column | None = None) -> DataFrame:
    """One row per row of ``df``: id, key (if asked for), size, text_crc32,
    shard and slot."""
    rows = sized_rows(df, id_column, column, list(dimensions), key)
    dealt, found = points(rows, shards, whole)
    leaves = tree(found, shards).select("digest", "part", "shard")
    return numbered(dealt.join(leaves, ["digest", "part"]).select("id", "row", "key", "size", "text_crc32", "shard")).drop("row")


def write_shards(df: DataFrame, path: str, id_column: str = "doc_id", column: str = "text", dimensions: list[str] = ("lang", "source"),
                 shards: int | None = None, target_bytes: int | None = None, files: int = 8) -> None:
    """Writes the rows of ``df`` with all their columns as Parquet, a folder
    ``shard=<n>`` for each shard with at most ``files`` files.  Shards come as a
    number, or as the bytes of one."""
    safe, name, back = safe_names(df)
    if shards is None:
        total = safe.agg(F.sum(F.coalesce(F.octet_length(F.col(name[column])), F.lit(0)).cast("long") + ROW_BYTES)).first()[0] or 0
        shards = max(1, math.ceil(total / target_bytes)) if target_bytes else SHARDS
    key = row_key(safe)
    rows = stage(assign(safe, name[id_column], name[column], [name[d] for d in dimensions], shards, key=key), "shards")
    whole = whole_rows(safe, key, rows, rows.select("key", "shard", "slot"))
    named = whole.select(*back, "shard", "slot")
    named.repartition("shard", F.pmod("slot", F.lit(files))).drop("slot").write.partitionBy("shard").parquet(path)


def op13(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return assign(docs).select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                               F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
