"""The library works where executors do not have its folder."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from trajex.session import local_session
from trajex.plans.queries import Q
spark = local_session(2)
print("rows", Q["lane_change_pipeline"](spark, {sf!r}).count())
"""


def test_pipeline_runs_from_another_folder(tmp_path, sf_small):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, sf=sf_small)], cwd=tmp_path, env=env,
                          capture_output=True, text=True, timeout=300)
    assert "rows" in done.stdout, done.stderr[-2000:]
