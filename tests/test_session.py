"""Sessions without any preset configuration."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

CODE = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None, "preset"
from trajex.operators import sequence as seq
from trajex.session import checkpoint_dir, clear_intermediates
df = spark.createDataFrame([("r", float(k), float(k), 0.0, 0.0) for k in range(20)],
                           "recording_id string, ptp_time double, PositionX double, PositionY double, PositionZ double")
assert seq.position_stitch(df, ["recording_id"]).count() == 20
import os
where = checkpoint_dir(spark)
assert where == checkpoint_dir(spark) and spark.sparkContext.getCheckpointDir()
assert clear_intermediates(spark) > 0
assert not any(f.endswith(".parquet") for _, _, names in os.walk(where.removeprefix("file:")) for f in names)
print("fine")
"""


def test_a_plain_local_session_works(tmp_path):
    conf = tmp_path / "conf"
    conf.mkdir()
    env = {**os.environ, "SPARK_CONF_DIR": str(conf), "TMPDIR": str(tmp_path), "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", CODE], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("fine"), done.stderr[-3000:]
