"""Exact duplicates by a heavy-hitter split.

Digests of the normalised texts are computed in one pass over the texts; all
later work is on (digest, id) rows.  Misra-Gries counters per task, merged by
addition, name at most ``counters`` digests that may be frequent; every digest
with more than rows / (counters + 1) rows is among them.  An exact count
verifies them, and the winners of the frequent ones (at most ``counters`` rows)
are broadcast, so rows of huge groups get their answer where they lie.  All
other digests go through an ordinary shuffled aggregation and join.

Null texts count as empty and equal empty texts.  The row with the largest id
stays; null ids are smaller than all others.  Of rows with the same text and
the same id (repeated rows, or several null ids) exactly one stays.  Columns of
any name pass through ``deduplicate`` unchanged.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajex.llm.common import append_columns, row_key, safe_names, stage, text, whole_rows

#: Counters of the Misra-Gries summary: also the bound on broadcast winners.
COUNTERS = 1024


def with_digest(df: DataFrame, column: str = "text", to: str = "text_sha256") -> DataFrame:
    """Adds the hex SHA-256 of the UTF-8 text with A-Z lower-cased."""
    def make():
        # bytes.lower() changes A-Z only
        return lambda texts: [[hashlib.sha256((x or b"").lower()).hexdigest() for x in texts]]
    return append_columns(df, [column], make, [text(to)], as_bytes=True)


def misra_gries(digests: DataFrame, column: str, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` values of ``column`` that hold all values with more
    than rows / (counters + 1) rows.  One summary per task, at most
    ``counters`` rows each; summaries add up by value and the largest stay."""
    schema = T.StructType([T.StructField(column, T.StringType()), T.StructField("count", T.LongType())])

    def summarise(batches):
        held: dict[str, int] = {}
        for batch in batches:
            for value, n in Counter(batch.column(0).to_pylist()).items():
                held[value] = held.get(value, 0) + n
            if len(held) > counters:
                floor = sorted(held.values(), reverse=True)[counters]
                held = {value: n - floor for value, n in held.items() if n > floor}
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string()), pa.array(held.values(), pa.int64())],
                                             names=schema.fieldNames())

    summaries = digests.select(column).mapInArrow(summarise, schema)
    merged = summaries.groupBy(column).agg(F.sum("count").alias("count"))
    return merged.orderBy(F.desc("count"), column).limit(counters).select(column)


def groups(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """For rows (id, row, digest) adds the winner of each digest's group as a
    struct (id, row) and the size of the group."""
    def summary(part):
        return part.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("winner"), F.count("*").alias("group_size"))

    maybe = F.broadcast(misra_gries(rows, "digest", counters))
    frequent = stage(summary(rows.join(maybe, "digest", "left_semi")), "frequent-digests")
    marked = rows.join(F.broadcast(frequent), "digest", "left")
    rare = marked.filter(F.col("winner").isNull()).select("id", "row", "digest")
    return (marked.filter(F.col("winner").isNotNull())
            .unionByName(rare.join(summary(rare), "digest")))


def exact_groups(df: DataFrame, id_column: str = "doc_id", column: str = "text", counters: int = COUNTERS) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256."""
    digests = with_digest(df.select(F.col(id_column).alias("id"), F.col(column).alias("__text")), "__text", "digest")
    rows = stage(digests.select("id", F.monotonically_increasing_id().alias("row"), "digest"), "digests")
    return groups(rows, counters).select(
        F.col("id").alias(id_column), F.col("winner.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("winner.row")).alias("kept"), F.col("digest").alias("text_sha256"))


def deduplicate(df: DataFrame, id_column: str = "doc_id", column: str = "text", counters: int = COUNTERS) -> DataFrame:
    """The rows that stay, with all their columns.  Of rows with the same text
    and the same largest id the one with the largest digest of all its columns
    stays, so reruns agree."""
    safe, name, back = safe_names(df)
    key = row_key(safe)
    light = safe.select(F.col(name[id_column]).alias("id"), key.alias("row"), F.col(name[column]).alias("__text"))
    rows = stage(with_digest(light, "__text", "digest").select("id", "row", "digest"), "digests")
    winners = groups(rows, counters).filter(F.col("row") == F.col("winner.row")).select(F.col("row").alias("key")).distinct()
    return whole_rows(safe, key, rows.select(F.col("row").alias("key")), winners).select(*back)


def op4(spark, sf_dir: str) -> DataFrame:
    return exact_groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


OP4_SQL = """
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS text_sha256
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""
