"""Signal sources.

Streams are stored as parquet per (dataset, table), partitioned by
``recording_id`` so that picking one recording prunes partitions instead
of globbing file names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_path(root: str, dataset: str, table: str) -> str:
    return f"{root.rstrip('/')}/{dataset}/{table}"


def scan_recording(spark: SparkSession, root: str, dataset: str, table: str,
                   recording_id: str | list[str] | None = None,
                   schema: T.StructType | None = None) -> DataFrame:
    """A stream's parquet set, all recordings or some.  The recording
    filter is on the partition column, so only those folders are listed
    and read."""
    rd = spark.read.schema(schema) if schema is not None else spark.read
    df = rd.parquet(stream_path(root, dataset, table))
    if recording_id is None:
        return df
    ids = [recording_id] if isinstance(recording_id, str) else list(recording_id)
    return df.where(F.col("recording_id").isin(*ids))


def write_recordings(df: DataFrame, root: str, dataset: str, table: str) -> None:
    """Store a stream partitioned by recording (the layout S1 reads)."""
    df.write.mode("overwrite").partitionBy("recording_id").parquet(stream_path(root, dataset, table))


def read_signal_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S3: signal CSV whose first column is a row index; the index column is
    dropped.  With ``schema`` (signal columns only) nothing is inferred."""
    if schema is not None:
        full = T.StructType([T.StructField("_index", T.LongType())] + list(schema.fields))
        return spark.read.schema(full).option("header", True).csv(path).drop("_index")
    raw = spark.read.option("header", True).option("inferSchema", True).csv(path)
    return raw.drop(raw.columns[0])


def write_signal_csv(df: DataFrame, path: str) -> None:
    """Write signals as CSV with a leading row index column (unique, not
    dense: it only marks the layout of the exported files)."""
    out = df.withColumn("_index", F.monotonically_increasing_id()).select("_index", *df.columns)
    out.write.mode("overwrite").option("header", True).csv(path)
