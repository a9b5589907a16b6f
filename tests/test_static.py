"""Source checks over the library package."""

import os
import re

PKG = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "trajex")


def _sources():
    for root, folders, files in os.walk(PKG):
        if "llm" in folders:  # has bounds of its own, tested with it
            folders.remove("llm")
        for f in files:
            if f.endswith(".py"):
                path = os.path.join(root, f)
                with open(path) as fh:
                    yield path, fh.read()


def test_no_local_checkpoints_driver_collects_or_rdds():
    bad = [p for p, src in _sources()
           if re.search(r"localCheckpoint|toPandas\(|\.rdd\b|crossJoin", src)]
    assert bad == []
    # what comes to the driver states its bound beside the call
    unbounded = [(p, line) for p, src in _sources() for line in src.split("\n")
                 if ".collect()" in line and not re.search(r"#.*(at most|of one page|whose last rows went)", line)]
    assert unbounded == []


def test_no_row_at_a_time_udfs():
    bad = [p for p, src in _sources() if re.search(r"\bF\.udf\b|@udf|pandas_udf", src)]
    assert bad == []
