"""Session and lineage helpers.

The library never builds a session inside an operator; callers pass one in.
``local_session`` is for tests and the bench.  ``checkpoint_dir`` reads the
cluster's shared ``spark.checkpoint.dir``; only when it is unset (local runs)
a fresh scratch folder is made.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int | None = None,
                  app: str = "trajex", event_log_dir: str | None = None) -> SparkSession:
    """Local session for tests and the bench (UI off).  ``event_log_dir``
    writes Spark's event log there, the source for stage and task times."""
    parts = shuffle_partitions or (8 if cores == "*" else max(2, 2 * int(cores)))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_scratch: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster in
    ``spark.checkpoint.dir``.  Only where the session has none and runs in
    local mode (tests) one scratch folder per application is made; the setting
    itself is fixed once a session runs.  On a cluster a machine-local folder
    would not be shared, so a missing setting is an error."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir() or _scratch.get(sc.applicationId)
    if not current:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        current = _scratch[sc.applicationId] = tempfile.mkdtemp(prefix="trajex-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as parquet under the shared checkpoint folder and
    read it back.  Used where an operator needs two passes over an
    intermediate: both passes then read the written table instead of each
    recomputing (and re-shuffling) the whole upstream plan, and a lost
    executor only costs the tasks of the current stage."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stages/{name}-{uuid.uuid4().hex[:12]}"
    note_written(spark, path)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_written: dict[str, list[str]] = {}


def note_written(spark: SparkSession, path: str) -> None:
    """Remembers an intermediate folder of this application."""
    _written.setdefault(spark.sparkContext.applicationId, []).append(path)


def clear_intermediates(spark: SparkSession) -> int:
    """Removes the intermediates that this application's operators wrote and
    returns their number.  For callers that have written their results: a
    DataFrame that still reads an intermediate cannot be evaluated again."""
    sc = spark.sparkContext
    paths = _written.pop(sc.applicationId, [])
    for path in paths:
        where = sc._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)
    return len(paths)


_shipped: dict[str, str] = {}


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in the executors' Python workers, also
    where neither the working folder nor PYTHONPATH holds it: a zip of the
    sources goes to the executors through Spark, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="trajex-"), "trajex.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, names in sorted(os.walk(here)):
            for name in sorted(names):
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(here)))
    sc.addPyFile(path)
    _shipped[sc.applicationId] = path


def bounded_rows(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.  Costs one job that
    stops reading after ``max_rows + 1`` rows, so it is a proven size bound
    for a broadcast decision rather than an optimizer estimate."""
    return df.limit(max_rows + 1).count() <= max_rows


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
