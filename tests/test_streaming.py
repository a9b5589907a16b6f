import tempfile

from trajex.operators import labels as lab
from trajex.plans import queries as qm
from trajex.plans import scenario as scn
from trajex.sources import fixtures as fx
from trajex.sources import recordings as rc
from trajex.streaming import incremental as inc


def test_incremental_labelling_matches_batch(spark, sf_small):
    root = tempfile.mkdtemp(prefix="streams-", dir="/tmp")
    rc.write_recordings(fx.ego(spark, sf_small), root, "reference", "ego")
    rc.write_recordings(fx.objects(spark, sf_small), root, "reference", "object")
    rc.write_recordings(fx.status(spark, sf_small), root, "sut", "vehicle")
    out = f"{root}/labels"
    q = inc.start_labelling(spark, root, fx.intervals(spark, sf_small), out, f"{root}/_ckpt",
                            available_now=True, max_files=7)
    q.awaitTermination(600)
    got = sorted(map(tuple, lab.label_counts(spark.read.parquet(out)).collect()))
    want = sorted(map(tuple, lab.label_counts(scn.scenario_labels(qm.scene_inputs(spark, sf_small))).collect()))
    assert got == want


def test_replayed_batches_do_not_duplicate(spark, sf_small):
    root = tempfile.mkdtemp(prefix="streams-", dir="/tmp")
    rc.write_recordings(fx.ego(spark, sf_small), root, "reference", "ego")
    rc.write_recordings(fx.objects(spark, sf_small), root, "reference", "object")
    rc.write_recordings(fx.status(spark, sf_small), root, "sut", "vehicle")
    out, iv = f"{root}/labels", fx.intervals(spark, sf_small)
    inc.start_labelling(spark, root, iv, out, f"{root}/_ckpt", available_now=True).awaitTermination(600)
    first = spark.read.parquet(out).count()
    # same checkpoint: nothing new to do
    inc.start_labelling(spark, root, iv, out, f"{root}/_ckpt", available_now=True).awaitTermination(600)
    assert spark.read.parquet(out).count() == first
    # lost checkpoint: every batch replays and overwrites its recordings
    inc.start_labelling(spark, root, iv, out, f"{root}/_ckpt2", available_now=True,
                        max_files=3).awaitTermination(600)
    assert spark.read.parquet(out).count() == first == 1297
