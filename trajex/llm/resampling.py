"""Importance resampling towards a target distribution.

Texts become bags of hashed word runs: a 256-byte table lower-cases A-Z and
blanks separators in the UTF-8 bytes, ``bytes.split`` yields the words, and
``zlib.crc32`` of a run goes on from the checksum of the run before it (a
checksum is the seed for the bytes that follow), so longer runs cost one call
each and no joined bytes.  Counters of the buckets add up per task, then in one
aggregation of at most tasks * buckets rows.

A bucket's gain is the logarithm of its share among the target's features over
its share among all documents' features, both with one added count a bucket.  A
document's weight is the mean gain of its features; a fixed pseudorandom Gumbel
number per id is added, and the documents with the highest sums are a draw
without replacement with odds by weight.

The order over all documents is a range partitioning by score: places inside a
range plus the sizes of the ranges before it, so no task sees all rows and the
share drawn may grow with the input.

Null texts have no words: no features, weight 0, never drawn unless
``least_words`` is 0.  Null ids draw the number of the empty id and come last
among equal scores; repeated rows are separate documents with the same score
and take different ranks.  Empty tables give empty results; an empty target
gives every bucket the share of one count.  Texts are cut into blocks of words
only for memory: runs go on across the blocks.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajex.llm.common import append_columns, long, safe_names, row_key, small_join, stage, table, whole_rows
from trajex.session import ship_package

#: Buckets of features, longest run of words, share drawn in percent, words a
#: drawn document has at least, and the draw's seed.
BUCKETS, RUN, PERCENT, LEAST_WORDS, SEED = 10_000, 2, 25, 20, 7
#: Bytes of a text whose words are held at once.
BLOCK = 1 << 20

#: Lower-cases A-Z; all but digits, letters and bytes of other characters is blank.
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def word_blocks(value: bytes, run: int = RUN, block: int = BLOCK):
    """(words, carried): the words of a text, block by block, each after the
    first led by the last run - 1 words of those before it."""
    clean, at, before = value.translate(TABLE), 0, []
    while at < len(clean):
        stop = clean.find(b" ", at + block)
        stop = len(clean) if stop < 0 else stop
        words = before + clean[at:stop].split()
        yield words, len(before)
        before, at = words[max(0, len(words) - run + 1):] if run > 1 else [], stop


def checksums(words: list[bytes], carried: int, run: int = RUN) -> list[int]:
    """CRC-32 of every run of 1 to ``run`` words that ends after the carried ones."""
    ends = list(map(zlib.crc32, words))
    found = ends[carried:]
    for k in range(1, run):
        ends = list(map(zlib.crc32, words[k:], map(zlib.crc32, repeat(b" "), ends)))
        found += ends[max(0, carried - k):]
    return found


def buckets_of(value: bytes, run: int = RUN, buckets: int = BUCKETS):
    """(words, buckets of the features) of a text, block by block."""
    for words, carried in word_blocks(value, run):
        codes = np.array(checksums(words, carried, run), np.uint32) % buckets
        yield len(words) - carried, codes


def feature_counts(df: DataFrame, column: str = "text", run: int = RUN, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n) over all texts of ``df``: at most ``buckets`` rows."""
    ship_package(df.sparkSession)

    def count(batches):
        held: Counter[int] = Counter()
        for batch in batches:
            for value in batch.column(0).cast(pa.binary()):
                for _, codes in buckets_of(value.as_py() or b"", run, buckets):
                    held.update(codes.tolist())
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.int64()), pa.array(held.values(), pa.int64())], names=["bucket", "n"])

    return df.select(F.col(f"`{column}`").cast("string")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(every: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's shares, rounded down."""
    s_all, t_all = float(sum(every.values()) + buckets), float(sum(target.values()) + buckets)
    return np.array([math.floor(1000 * math.log((target.get(b, 0) + 1.0) * s_all / ((every.get(b, 0) + 1.0) * t_all)))
                     for b in range(buckets)], np.int64)


def weighed(df: DataFrame, gain: np.ndarray, column: str = "text", run: int = RUN) -> DataFrame:
    """Adds n_words, n_features and weight, the mean gain of a text's features
    rounded down (0 without features)."""
    shared = df.sparkSession.sparkContext.broadcast(gain)  # a number a bucket, whatever the input

    def make():
        gain = shared.value

        def weigh(texts):
            rows = []
            for value in texts:
                words = features = total = 0
                for new, codes in buckets_of(value or b"", run, len(gain)):
                    words, features, total = words + new, features + len(codes), total + int(gain[codes].sum())
                rows.append((words, features, total // features if features else 0))
            return list(zip(*rows, strict=True)) if rows else [[], [], []]
        return weigh

    return append_columns(df, [column], make, [long("n_words"), long("n_features"), long("weight")], as_bytes=True)


def gumbel(identifier: Column, seed: int = SEED) -> Column:
    """Thousandths of a Gumbel number, rounded down, that an id always gets."""
    told = F.concat(F.lit(f"{seed}:"), F.coalesce(identifier.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(told, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def in_order(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Adds ``place`` (from 1) in an order over all rows.  Rows are dealt to
    ranges and sorted there; a row's number in its range is the low part of
    the id that Spark gives it, the range the high part."""
    ranges = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    at = F.col("__at")
    kept = stage(dealt.withColumn("__at", F.monotonically_increasing_id())
                 .withColumn("__range", F.shiftright(at, 33)).withColumn("__in", at.bitwiseAND(F.lit((1 << 33) - 1))).drop("__at"), "in-order")
    sizes = kept.groupBy("__range").agg(F.count("*").alias("n"))  # a row for each range
    before = F.coalesce(F.sum("n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = sizes.select("__range", before.alias("__start"))
    return small_join(kept, starts, "__range", "inner").withColumn("place", F.col("__start") + F.col("__in") + 1).drop("__range", "__in", "__start")


def fit(df: DataFrame, target: DataFrame, column: str = "text", target_column: str = "text", run: int = RUN, buckets: int = BUCKETS) -> np.ndarray:
    """Gains of the buckets, from counts over all rows of both tables."""
    every, wanted = ({r["bucket"]: r["n"] for r in feature_counts(d, c, run, buckets).collect()}  # at most ``buckets`` rows each
                     for d, c in ((df, column), (target, target_column)))
    return gains(every, wanted, buckets)


def ranked(df: DataFrame, gain: np.ndarray, id_column: str = "doc_id", column: str = "text", key: Column | None = None,
           percent: int = PERCENT, least_words: int = LEAST_WORDS, run: int = RUN, seed: int = SEED) -> DataFrame:
    """One row per row of ``df``: id, key (if asked for), n_features, weight,
    score and rank (null if not drawn)."""
    light = df.select(F.col(f"`{id_column}`").alias("id"), (key if key is not None else F.lit(None).cast("binary")).alias("key"),
                      F.col(f"`{column}`").cast("string").alias("__text"))
    rows = weighed(light, gain, "__text", run).drop("__text")
    rows = stage(rows.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)).withColumn("may", F.col("n_words") >= least_words)
                 .withColumn("row", F.monotonically_increasing_id()), "weights")
    drawn = rows.filter("may").count() * percent // 100
    placed = in_order(rows, [F.col("may").desc(), F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("key"), F.col("row")])
    return placed.select("id", "key", "n_features", "weight", "score",
                         F.when(F.col("may") & (F.col("place") <= drawn), F.col("place")).alias("rank"))


def resample(df: DataFrame, target: DataFrame, id_column: str = "doc_id", column: str = "text", target_column: str = "text", **how) -> DataFrame:
    """The drawn rows of ``df`` with all their columns.  Of repeated rows as
    many stay as were drawn."""
    gain = fit(df, target, column, target_column)
    safe, name, back = safe_names(df)
    key = row_key(safe)
    rows = stage(ranked(safe, gain, name[id_column], name[column], key, **how), "ranks")
    return whole_rows(safe, key, rows, rows.filter("rank is not null").select("key")).select(*back)


def op12(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    gain = fit(docs, table(spark, sf_dir, "benchmark").select("text"))
    return ranked(docs, gain).select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")
