"""Connected components by repeated contraction.

In each round every node points to the neighbour (or itself) of the smallest
hash and all edges move along the pointers; edges inside one node vanish.  The
hash changes with the round, so long chains shrink by a constant share too.
Each round's tables are written to the shared folder; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajex.llm.common import stage


def spanning(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b; long, not null).  Two
    nodes have the same root if and only if a path links them.  Repeated edges,
    both directions and loops are fine; no edges give no rows."""
    # the smaller end first, once
    edges = stage(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    labels = stage(edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                   .withColumn("root", F.col("node")), "labels")
    turn = 0
    edges = edges.filter("a <> b")
    while not edges.isEmpty():
        def rank(node: str, turn: int = turn):
            return F.struct(F.xxhash64(F.lit(turn), node).alias("rank"), F.col(node).alias("to"))

        both = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("near")),
                                              F.struct(F.col("b").alias("node"), F.col("a").alias("near")))).alias("e")).select("e.*")
        near = both.groupBy("node").agg(F.min(rank("near")).alias("best"))
        parents = stage(near.select("node", F.least("best", rank("node"))["to"].alias("to")), "parents")
        moved = (edges.join(parents.select(F.col("node").alias("a"), F.col("to").alias("to_a")), "a")
                 .join(parents.select(F.col("node").alias("b"), F.col("to").alias("to_b")), "b"))
        ends = [F.col("to_a"), F.col("to_b")]
        labels = stage(labels.join(parents.select(F.col("node").alias("root"), "to"), "root", "left")
                       .select("node", F.coalesce("to", "root").alias("root")), "labels")
        edges = stage(moved.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).filter("a <> b").distinct(), "edges")
        turn += 1
    return labels
