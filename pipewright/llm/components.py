"""Connected components of an edge list by min-label rounds with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipewright.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b) -> (node, comp): every node of an edge with the smallest node reachable from it.

    Each round takes the least label among a node's neighbours (partially
    aggregated before the shuffle) and then the label of that label. Labels
    are written out every round; only the number of changes reaches the driver.
    """
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    e = cut(both.where("a <> b").groupBy("a", "b").agg(F.lit(1).alias("__one")).select("a", "b"))
    labels = cut(e.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("comp")))
    while True:
        lab = labels.select(F.col("node").alias("__n"), F.col("comp").alias("__c"))
        near = e.join(lab, e["b"] == lab["__n"]).groupBy("a").agg(F.min("__c").alias("m"))
        step = labels.join(near, labels["node"] == near["a"]).select("node", F.col("comp").alias("old"),
                                                                   F.least("comp", "m").alias("c"))
        jump = step.join(lab, step["c"] == lab["__n"], "left").select(
            "node", "old", F.least("c", F.coalesce("__c", "c")).alias("comp"))
        jump = cut(jump)
        changed = jump.where("comp <> old").count()
        labels = jump.select("node", "comp")
        if changed == 0:
            return labels
