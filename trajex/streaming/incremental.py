"""Incremental scenario labelling with Structured Streaming.

Recordings land as complete parquet partitions (``recording_id=...``) of the
object stream.  A file-source stream notices new files; each micro-batch
takes the recording ids it saw, reads ego, object and status rows of just
those recordings (partition pruning), runs the batch pipeline (L5) and
overwrites the output partitions of those recordings.  Re-running a batch
after a failure rewrites the same partitions, so the sink is idempotent;
progress lives in the checkpoint folder, which must be on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from trajex.plans.scenario import SceneInputs, scenario_labels
from trajex.schema import Thresholds
from trajex.sources.recordings import scan_recording


def label_batch(spark: SparkSession, root: str, intervals: DataFrame, recordings: DataFrame,
                th: Thresholds = Thresholds()) -> DataFrame:
    """L5 for the recordings in ``recordings`` (one column recording_id),
    read from the stream store under ``root``.  The semi joins on the
    partition column let dynamic partition pruning skip other recordings."""
    ids = recordings.select("recording_id").distinct()

    def only(df: DataFrame) -> DataFrame:
        return df.join(ids, "recording_id", "left_semi")

    inp = SceneInputs(
        ego=only(scan_recording(spark, root, "reference", "ego")),
        objects=only(scan_recording(spark, root, "reference", "object")),
        status=only(scan_recording(spark, root, "sut", "vehicle")),
        intervals=only(intervals))
    return scenario_labels(inp, th)


def start_labelling(spark: SparkSession, root: str, intervals: DataFrame, out_path: str,
                    checkpoint: str, *, available_now: bool = False, max_files: int = 1000,
                    th: Thresholds = Thresholds()) -> StreamingQuery:
    """Start the stream.  ``available_now`` processes what is there and stops
    (a scheduled incremental run); otherwise it keeps polling."""
    objects_dir = f"{root.rstrip('/')}/reference/object"
    schema = spark.read.parquet(objects_dir).schema
    new_files = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
                 .parquet(objects_dir).select("recording_id"))

    def run(batch: DataFrame, epoch_id: int) -> None:
        ids = batch.select("recording_id").distinct()
        (label_batch(batch.sparkSession, root, intervals, ids, th).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("recording_id").parquet(out_path))

    writer = new_files.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
