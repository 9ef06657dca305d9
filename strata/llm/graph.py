"""Connected components by written rounds of minimum labels and pointer jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import drop_written, written


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node of an undirected edge list of longs.

    The component is its smallest node. Every round takes the smallest label
    among a node's neighbours and then jumps to that label's own label, so
    paths halve. A hub costs nothing special: minima are taken before the
    shuffle, and the joins are between plain tables that AQE can split.
    """
    both = written(edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y").unionByName(
        edges.select(F.col(b).alias("x"), F.col(a).alias("y")).where("x <> y")).distinct(), "edges")
    labels = written(both.groupBy("x").agg(F.min("y").alias("y")).select(
        F.col("x").alias("node"), F.least("x", "y").alias("component")), "labels")
    while True:
        near = both.join(labels, F.col("y") == F.col("node")).groupBy("x").agg(
            F.min("component").alias("near"))
        step = labels.join(near, F.col("node") == F.col("x")).select(
            "node", F.col("component").alias("old"), F.least("component", "near").alias("mid"))
        jump = labels.select(F.col("node").alias("mid"), F.col("component").alias("far"))
        new = written(step.join(jump, "mid").select("node", F.least("mid", "far").alias("component"),
                                                    (F.least("mid", "far") != F.col("old")).alias("moved")),
                      "labels")
        moved = new.where("moved").limit(1).count()
        drop_written(labels.sparkSession, labels)
        labels = new.drop("moved")
        if not moved:
            drop_written(both.sparkSession, both)
            return labels
