"""Keyed table maintenance.

Tables are DataFrames read from a path or catalog name.  Key sets are
DataFrames with the key columns.  Key matching is null-safe (a null key
value matches a null column value), as an ``IS NULL`` test would.
Updates never overwrite the path they read: the new version is written
beside it and the caller swaps (``write_beside``)."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajex.schema import DATE_TEXT_FORMAT
from trajex.session import bounded_rows, checkpoint_dir, note_written

KEY_BROADCAST_MAX_ROWS = 250_000


def _key_cond(left: DataFrame, right: DataFrame, cols: list[str]) -> Column:
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[c])
        cond = e if cond is None else cond & e
    return cond


def _maybe_broadcast(keys: DataFrame, max_rows: int = KEY_BROADCAST_MAX_ROWS) -> DataFrame:
    return F.broadcast(keys) if bounded_rows(keys, max_rows) else keys


def read_table(spark: SparkSession, path_or_name: str, fmt: str = "parquet") -> DataFrame:
    """A whole table, by catalog name or by path."""
    if "/" not in path_or_name and spark.catalog.tableExists(path_or_name):
        return spark.table(path_or_name)
    return spark.read.format(fmt).load(path_or_name)


def key_lookup(table: DataFrame, keys: DataFrame, cols: list[str]) -> DataFrame:
    """Rows of ``table`` for each key tuple; a key given twice returns
    its rows twice (an inner join, not a semi join).  Returns the table's
    columns; an empty result keeps the schema."""
    k = _maybe_broadcast(keys.select(*cols))
    t = table.alias("t")
    j = t.join(k.alias("k"), _key_cond(t, k, cols), "inner")
    return j.select(*[F.col(f"t.{c}") for c in table.columns])


def key_exists(table: DataFrame, keys: DataFrame, cols: list[str]) -> DataFrame:
    """For each key row (with any extra columns such as an ordinal), a
    boolean ``exists``.  Keys of a checked size are broadcast, so only the
    table's rows that have one of them reach the shuffle of ``distinct``; then
    the result has one row per key row.  Keys may come from the table itself."""
    renamed = {c: f"_k{n}" for n, c in enumerate(cols)}
    held = table.select(*(F.col(f"`{c}`").alias(r) for c, r in renamed.items()))
    asked = keys.select(*(F.col(f"`{c}`").alias(f"{r}_asked") for c, r in renamed.items())).distinct()
    if bounded_rows(asked, KEY_BROADCAST_MAX_ROWS):
        held = held.join(F.broadcast(asked), [F.col(r).eqNullSafe(F.col(f"{r}_asked")) for r in renamed.values()], "left_semi")
    held = held.distinct().withColumn("_hit", F.lit(True))
    j = keys.join(held, [F.col(f"`{c}`").eqNullSafe(F.col(r)) for c, r in renamed.items()], "left")
    return j.select(*(F.col(f"`{c}`") for c in keys.columns), F.coalesce(F.col("_hit"), F.lit(False)).alias("exists"))


def stamp(df: DataFrame, date_col: str, when: str | None = None) -> DataFrame:
    """Add the write-date text column (``yyyy/MM/dd_HH:mm:ss``)."""
    value = F.lit(when) if when is not None else F.date_format(F.current_timestamp(), DATE_TEXT_FORMAT)
    return df.withColumn(date_col, value)


def replace_rows(table: DataFrame, new_rows: DataFrame, keys: DataFrame, cols: list[str], *,
                 date_col: str | None = None, when: str | None = None) -> DataFrame:
    """Remove the rows matching any key tuple, then add every new row
    once (also when no row matched), stamped with the write date."""
    k = _maybe_broadcast(keys.select(*cols).distinct())
    t = table.alias("t")
    kept = t.join(k.alias("k"), _key_cond(t, k, cols), "left_anti")
    add = stamp(new_rows, date_col, when) if date_col else new_rows
    return kept.unionByName(add, allowMissingColumns=True)


def update_by_key(table: DataFrame, updates: dict, keys: DataFrame, cols: list[str]) -> DataFrame:
    """Set the given columns to constants on rows whose key tuple is in
    ``keys``; other rows are unchanged.  Row count is preserved.  Keys may come
    from the table itself."""
    renamed = {c: f"_k{n}" for n, c in enumerate(cols)}
    k = _maybe_broadcast(keys.select(*(F.col(f"`{c}`").alias(r) for c, r in renamed.items())).distinct().withColumn("_hit", F.lit(True)))
    j = table.join(k, [F.col(f"`{c}`").eqNullSafe(F.col(r)) for c, r in renamed.items()], "left")
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    out = []
    for c in table.columns:
        own = F.col(f"`{c}`")
        out.append(F.when(hit, F.lit(updates[c]).cast(table.schema[c].dataType)).otherwise(own).alias(c) if c in updates else own)
    return j.select(*out)


def outer_union(old: DataFrame, new: DataFrame, drop: tuple[str, ...] = ()) -> DataFrame:
    """Rows of both frames; columns missing on one side are null."""
    return old.unionByName(new.drop(*drop), allowMissingColumns=True)


def write_table(df: DataFrame, path: str, *, append: bool = True, date_col: str | None = None,
                when: str | None = None, history: bool = False) -> None:
    """Append (default) or replace; optional write-date column; optional
    append of the same rows to ``<path>_history``."""
    out = stamp(df, date_col, when) if date_col else df
    out.write.mode("append" if append else "overwrite").parquet(path)
    if history:
        out.write.mode("append").parquet(path.rstrip("/") + "_history")


def write_beside(df: DataFrame, path: str) -> str:
    """Write a new version next to ``path`` (never over the input being
    read) and return the new location; the caller repoints readers."""
    new = f"{path.rstrip('/')}__v{uuid.uuid4().hex[:12]}"
    df.write.mode("errorifexists").parquet(new)
    return new


def swap(spark: SparkSession, path: str, new: str) -> str:
    """Puts the table at ``new`` in the place of the one at ``path`` and returns
    where the old version now lies.  Two renames: if the second fails, the old
    version is put back."""
    old = f"{path.rstrip('/')}__old{uuid.uuid4().hex[:12]}"
    _rename(spark, path, old)
    try:
        _rename(spark, new, path)
    except Exception:
        _rename(spark, old, path)
        raise
    return old


def _hadoop(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _rename(spark: SparkSession, a: str, b: str) -> None:
    source, fs = _hadoop(spark, a)
    if not fs.exists(source) or not fs.rename(source, _hadoop(spark, b)[0]):
        raise OSError(f"cannot rename {a} to {b}")


def write_partitioned(df: DataFrame, path: str, by: list[str]) -> None:
    """A table with a folder for every combination of values of ``by``."""
    df.repartition(*by).write.mode("errorifexists").partitionBy(*by).parquet(path)


def rewrite_partitions(spark: SparkSession, path: str, by: list[str], keys: DataFrame, cols: list[str], change, more: DataFrame | None = None) -> int:
    """T1, T2 on a stored table with partitions ``by``: applies ``change`` (a
    function of a DataFrame) to the partitions that hold a row with one of the
    ``keys`` or that take rows of ``more``; all other partitions keep their
    files.  Returns the number of partitions rewritten.

    The partitions are found by a semi join on the key columns alone, so only
    those columns are read of the rest.  The changed rows are written beside the
    table first.  Spark then writes their partitions into a staging folder and
    moves them into place when all tasks are done, so a failure while rows are
    worked out or written leaves the old version readable.  Partitions left
    without rows are removed last.  ``change`` sees the partition columns as
    text, as the folders are named."""
    # folder names are text: read as such, "01" is not written back as 1
    found = spark.read.parquet(path).schema
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name in by else f for f in found.fields])
    table = spark.read.schema(schema).parquet(path)
    renamed = {c: f"_k{n}" for n, c in enumerate(cols)}
    asked = _maybe_broadcast(keys.select(*(F.col(f"`{c}`").alias(r) for c, r in renamed.items())).distinct())
    held = table.select(*dict.fromkeys([*by, *cols])).join(asked, [F.col(f"`{c}`").eqNullSafe(F.col(r)) for c, r in renamed.items()], "left_semi").select(*by)
    if more is not None:
        held = held.unionByName(more.select(*(F.col(c).cast(table.schema[c].dataType).alias(c) for c in by)))
    touched = scratch_path(spark, "touched")
    held.distinct().write.parquet(touched)
    parts = spark.read.schema(held.schema).parquet(touched)
    marked = parts.select(*(F.col(c).alias(f"_p{n}") for n, c in enumerate(by)))
    inside = table.join(_maybe_broadcast(marked), [F.col(c).eqNullSafe(F.col(f"_p{n}")) for n, c in enumerate(by)], "left_semi")
    changed = scratch_path(spark, "changed")
    change(inside).select(*table.columns).write.parquet(changed)
    rows = spark.read.schema(table.schema).parquet(changed)
    rows.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    left = rows.select(*(F.col(c).alias(f"_p{n}") for n, c in enumerate(by))).distinct()
    empty = parts.join(left, [F.col(c).eqNullSafe(F.col(f"_p{n}")) for n, c in enumerate(by)], "left_anti")
    folders = spark.read.schema(schema).parquet(path).withColumn("_dir", F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", ""))
    gone = folders.join(F.broadcast(empty.select(*(F.col(c).alias(f"_p{n}") for n, c in enumerate(by)))),
                        [F.col(c).eqNullSafe(F.col(f"_p{n}")) for n, c in enumerate(by)], "left_semi").select("_dir").distinct()
    for r in gone.collect():  # folders whose last rows went
        where, fs = _hadoop(spark, r["_dir"])
        fs.delete(where, True)
    return parts.count()


def replace_in_store(spark: SparkSession, path: str, by: list[str], new_rows: DataFrame, keys: DataFrame, cols: list[str], *,
                     date_col: str | None = None, when: str | None = None) -> int:
    """T1 in place: ``replace_rows`` on the partitions it concerns."""
    add = stamp(new_rows, date_col, when) if date_col else new_rows

    def change(inside: DataFrame) -> DataFrame:
        kept = inside.alias("t").join(keys.select(*cols).distinct().alias("k"), [F.col(f"t.`{c}`").eqNullSafe(F.col(f"k.`{c}`")) for c in cols], "left_anti")
        return kept.unionByName(add.select(*(F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in inside.schema.fields if f.name in add.columns)), allowMissingColumns=True)
    return rewrite_partitions(spark, path, by, keys, cols, change, add)


def update_in_store(spark: SparkSession, path: str, by: list[str], updates: dict, keys: DataFrame, cols: list[str]) -> int:
    """T2 in place: ``update_by_key`` on the partitions it concerns.  The
    partition columns themselves cannot be updated."""
    if clash := set(updates) & set(by):
        raise ValueError(f"partition columns cannot be updated: {sorted(clash)}")
    return rewrite_partitions(spark, path, by, keys, cols, lambda inside: update_by_key(inside, updates, keys, cols))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's shared checkpoint folder."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
    note_written(spark, path)
    return path
