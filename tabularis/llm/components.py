"""Connected components of an edge table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabularis.llm.common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a long, b long); root is the smallest node reachable.

    Every round, a node takes the smallest label around it, then follows its label's label (pointer
    jumping), and the table is written to the shared folder; rounds go on until no label changes.
    Joins are on nodes and labels; a hub's rows are reduced by the map-side minimum.
    """
    both = edges.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(edges.select(F.col("b").alias("x"), F.col("a").alias("y")))
    both = written(both.distinct(), "edges")
    labels = written(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("root")).select(F.col("x").alias("node"), "root"), "labels")
    while True:
        pulled = both.join(labels, both["y"] == labels["node"]).groupBy("x").agg(F.min("root").alias("low"))
        near = labels.join(pulled, labels["node"] == pulled["x"]).select("node", "root", F.least("root", "low").alias("low"))
        jump = labels.select(F.col("node").alias("low"), F.col("root").alias("further"))
        step = near.join(jump, "low").select("node", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved"))
        step = written(step, "labels")
        labels = step.select("node", "root")
        if step.where("moved").isEmpty():
            return labels
