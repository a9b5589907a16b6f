"""Helpers shared by the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import sys
import uuid
from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from trajex.session import bounded_rows, checkpoint_dir, note_written, ship_package

#: Largest table that is broadcast, in rows; checked before each broadcast.
BROADCAST_ROWS = 50_000
#: Rows of a batch that are Python values at once.
AT_ONCE = 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Writes ``df`` once into the shared folder and reads it back: two passes
    read the same rows, and a lost executor costs only tasks of one stage.
    ``by``: a column of few values whose rows go to folders of their own, so
    that a filter on it reads no others."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"
    note_written(spark, path)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_join(df: DataFrame, small: DataFrame, on, how: str = "left") -> DataFrame:
    """Joins a table that usually is small: broadcast when a counted bound
    proves it, otherwise an ordinary shuffled join."""
    return df.join(F.broadcast(small) if bounded_rows(small, BROADCAST_ROWS) else small, on, how)


def append_columns(df: DataFrame, inputs: Sequence[str], make: Callable[[], Callable], fields: Sequence[T.StructField],
                   as_bytes: bool = False) -> DataFrame:
    """Adds columns that Python computes row by row inside Arrow batches.

    ``make()`` runs once per task and returns ``f(*lists)``, which gets one list
    of values per input column (UTF-8 bytes with ``as_bytes``) and returns one
    list per new column.  All input columns pass through; one whose name equals
    a new column's (in any case) gives way to it.  No shuffle.
    """
    ship_package(df.sparkSession)
    new = T.StructType(list(fields))
    taken = {f.name.lower() for f in fields}
    keep = [f for f in df.schema.fields if f.name.lower() not in taken]
    wanted = list(dict.fromkeys([f.name for f in keep] + list(inputs)))
    schema = T.StructType(keep + list(fields))
    kept, types = [f.name for f in keep], [f.type for f in to_arrow_schema(new)]

    def run(batches):
        compute = make()
        for batch in batches:
            for at in range(0, batch.num_rows, AT_ONCE):  # Python's own copies stay few
                part = batch.slice(at, AT_ONCE)
                given = [part.column(wanted.index(c)) for c in inputs]
                if as_bytes:
                    given = [c.cast(pa.binary()) if pa.types.is_string(c.type) else c for c in given]
                made = compute(*(c.to_pylist() for c in given))
                columns = [part.column(wanted.index(c)) for c in kept]
                columns += [pa.array(v, t) for v, t in zip(made, types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())

    return df.select(*(F.col(f"`{c}`") for c in wanted)).mapInArrow(run, schema)


def safe_names(df: DataFrame) -> tuple[DataFrame, dict[str, str], list[Column]]:
    """``df`` with columns named c0, c1, ..., so that names an operator adds
    clash with none; the new name of each old one, and the selection that gives
    the old names back."""
    names = {c: f"c{k}" for k, c in enumerate(df.columns)}
    return df.toDF(*names.values()), names, [F.col(new).alias(old) for old, new in names.items()]


def row_key(df: DataFrame) -> Column:
    """A digest of all values of a row; nulls differ from all values.  Rows
    with the same digest are the same in every column."""
    def told(c: str) -> Column:
        return F.sha2(F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("-")), 256)

    return F.unhex(F.sha2(F.concat(F.lit(""), *(told(c) for c in df.columns)), 256))


def whole_rows(df: DataFrame, key: Column, rows: DataFrame, decided: DataFrame) -> DataFrame:
    """What was ``decided`` for keys, each with a row of ``df`` that has its
    key; ``rows`` has the ``key`` of every row of ``df``.
    Texts cross the network once here instead of being written beside the
    decisions.  Only keys of repeated rows need to be thinned out first; as
    keys cover every column, it is the same which of them stays."""
    keyed = df.withColumn("__key", key)
    repeated = stage(rows.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1").select(F.col("key").alias("__key")), "repeated")
    if not repeated.isEmpty():
        keyed = keyed.join(repeated, "__key", "left_anti").unionByName(
            keyed.join(repeated, "__key", "left_semi").dropDuplicates(["__key"]))
    return keyed.join(decided.withColumnRenamed("key", "__key"), "__key").drop("__key")


_tool: list = [None, None]


def worker_tool(key, make: Callable):
    """What ``make()`` gives, kept in this Python worker until another tool is
    asked for, so that one tool's caches at a time take memory; what the last
    one held goes back to the system."""
    if _tool[0] != key:
        _tool[:] = [None, None]
        gc.collect()  # a tool and its caches refer to each other
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # where the C library has it
            ctypes.CDLL(None).malloc_trim(0)
        _tool[:] = [key, make()]
    return _tool[1]


def hash_share(key: Column, seed: int) -> Column:
    """A number from 0 up to 1 that a key always gets."""
    return F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 11) / float(1 << 53)


def bounded_sample(df: DataFrame, key: str, among: int, rows: int, seed: int = 7) -> DataFrame:
    """At most ``rows`` rows of ``df``, which has about ``among`` rows of
    different keys: those whose keys have the smallest hash shares.  A threshold
    leaves about twice as many as wanted, so few rows are ordered, whatever the
    number of tasks."""
    share = hash_share(F.col(key), seed)
    return df.filter(share <= min(1.0, 2 * rows / max(among, 1))).orderBy(share, key).limit(rows)


class WordCache(dict):
    """Results per word with a bound on their bytes and on the length of a
    word; only a saving of time.  Words and results lie in two halves of
    ``room`` bytes each: when the newer half is full it becomes the older one,
    from which words in use come back.  ``size`` tells a result's bytes."""

    ENTRY = 130  # of the table and the word's object

    def __init__(self, compute: Callable, room: int = 16 << 20, longest: int = 48, size: Callable = sys.getsizeof):
        super().__init__()
        self.compute, self.room, self.longest, self.size, self.older, self.used = compute, room, longest, size, {}, 0

    def __missing__(self, word):
        value = self.older.get(word)
        if value is None:
            value = self.compute(word)
        if len(word) <= self.longest:
            more = self.ENTRY + len(word) + self.size(value)
            if self.used + more > self.room:
                self.older, self.used = dict(self), 0
                self.clear()
            self[word] = value
            self.used += more
        return value


def long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def text(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())
