"""The scenario labelling pipeline as one Spark plan.

Order follows the module form: range-join each stream to the highway
intervals and put time on the 0.1 s grid, then filter and dedup objects,
summarise scenes, label, overlay.

Plan shape (see ``explain``):
* intervals are small and broadcast after a row-count check, so no signal
  stream is shuffled for the range join;
* objects are hash-partitioned once on (recording, integer time tick); the
  dedup, the per-scene window aggregates and the overlay joins all reuse
  that partitioning, so the large object stream is read once and crosses
  the network once;
* the status stream is scanned once for all three status labels;
* the ego side of the summary is aggregated before its join (eager
  aggregation), so the a*b join rows never exist.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from trajex.operators import filters as flt
from trajex.operators import labels as lab
from trajex.schema import OBJECT_COLUMNS, STATUS_CONGESTION, STATUS_NONE, Thresholds

KEY = lab.KEY
TK = ["recording_id", "_tk"]


@dataclass
class SceneInputs:
    """``stored``: ``objects`` come from ``object_store``, which carries the
    tick and lies in buckets by (recording, tick)."""
    ego: DataFrame
    objects: DataFrame
    status: DataFrame
    intervals: DataFrame
    stored: bool = False


def write_object_store(objects: DataFrame, name: str, buckets: int, path: str | None = None) -> None:
    """Stores objects as the catalog table ``name`` in ``buckets`` buckets by
    (recording, time tick), sorted within them, so that every run of L5 on it
    finds equal keys together: its dedup, its scene windows and its joins move
    no object.  ``path``: where the files go, else the warehouse."""
    # one task a bucket writes one file, so a bucket is read in its order
    placed = objects.withColumn("_tk", F.round(flt.time_grid("ptp_time") * 10).cast("long")).repartition(buckets, *TK)
    writer = placed.write.mode("errorifexists").bucketBy(buckets, *TK).sortBy(*TK)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def object_store(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def prepared(inp: SceneInputs, th: Thresholds = Thresholds()):
    """Highway-filtered ego (with speed), filtered and deduplicated objects
    (hash-partitioned on recording and time tick), projected status.  Each
    carries the integer time tick ``_tk``."""
    small = flt.intervals_broadcastable(inp.intervals)
    ego = (flt.ego_speed(flt.highway_filter(inp.ego, inp.intervals, broadcast=small))
           .withColumn("_tk", lab.time_key()))
    objects = flt.highway_filter(inp.objects, inp.intervals, broadcast=small)
    objects = flt.object_roi(objects, th)
    if not inp.stored:
        objects = objects.withColumn("_tk", lab.time_key()).repartition(*TK)
    objects = flt.object_dedup(objects, key=[c for c in OBJECT_COLUMNS if c in objects.columns] + ["_tk"])
    status = (flt.highway_filter(flt.status_projection(inp.status), inp.intervals, broadcast=small)
              .withColumn("_tk", lab.time_key()))
    return ego, objects, status


def scenario_labels(inp: SceneInputs, th: Thresholds = Thresholds(),
                    attach_speed: bool = False) -> DataFrame:
    """One pass over objects.  The object half of the scene summary (count,
    mean VelocityX per key) is a window over the existing (recording, tick)
    partitioning; the ego half and the status labels are small per-key
    aggregates joined on the same key.  Congestion is then a row condition
    and the overlay is ``greatest`` of the two codes.  ``attach_speed``
    joins J4 (vehicle speed per row) on the same key, so the objects keep their
    partitioning; no key's rows are collected into one value."""
    ego, objects, status = prepared(inp, th)
    w = Window.partitionBy(*TK)
    objs = (objects.withColumn("_a", F.count(F.lit(1)).over(w))
            .withColumn("_avg_v", F.avg("VelocityX").over(w)))
    ego_agg = ego.groupBy(*TK).agg(F.count(F.lit(1)).alias("_b"),
                                   F.avg("Velocity").alias("_ego_v"))
    if attach_speed:
        # Status is not deduplicated, so a key with several status rows
        # repeats the labelled row; a key without status keeps one row.  The
        # rows carry their key's code along, so status is read and joined once
        rows = status.select(*TK, "VehicleDirSAE_VehSpeed", lab.status_code(th).alias("_code"))
        st = rows.withColumn("_st", F.max("_code").over(w)).drop("_code")
    else:
        st = lab.status_labels(status, th, key=TK).withColumnRenamed("status", "_st")
    j = objs.join(ego_agg, TK, "left").join(st, TK, "left")
    congested = ((F.col("_a") * F.col("_b") > th.congestion_count_min)
                 & (F.col("_avg_v") < th.congestion_avg_v_max)
                 & (F.col("_ego_v") < th.congestion_ego_v_max))
    code = F.greatest(F.col("_st"), F.when(congested, F.lit(STATUS_CONGESTION)))
    return (j.withColumn("status", F.coalesce(code, F.lit(STATUS_NONE)))
            .drop("_a", "_avg_v", "_b", "_ego_v", "_st", "_tk"))


def scenario_labels_two_pass(inp: SceneInputs, th: Thresholds = Thresholds()) -> DataFrame:
    """Union-and-max overlay with the eager-aggregated summary (objects are
    read twice: once for the summary, once for the overlay)."""
    ego, objects, status = prepared(inp, th)
    summary = lab.scene_summary(objects, ego, key=TK)
    return lab.combine_status(objects, lab.status_labels(status, th, key=TK),
                              lab.label_congestion(summary, th, key=TK), key=TK).drop("_tk")


def scenario_labels_naive(inp: SceneInputs, th: Thresholds = Thresholds()) -> DataFrame:
    """The pipeline as first written: four label scans, join-then-aggregate
    summary, four chained overlay joins.  Kept for the bench comparison."""
    ego = flt.ego_speed(flt.highway_filter(inp.ego, inp.intervals))
    objects = flt.object_dedup(flt.object_roi(flt.highway_filter(inp.objects, inp.intervals), th))
    status = flt.highway_filter(flt.status_projection(inp.status), inp.intervals)
    summary = lab.scene_summary_naive(objects, ego)
    return lab.combine_status_by_set(
        objects, lab.label_lane_change(status, th), lab.label_emergency_brake(status, th),
        lab.label_turning(status, th), lab.label_congestion(summary, th))
