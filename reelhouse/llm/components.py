"""Connected components by minimum labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for the nodes of ``edges`` (a, b); label is the smallest node reachable.

    ``edges`` is a staged table. Each round sends labels along the links (with
    partial minima, so a node with many links gets one row a task) and then
    replaces a label by the label of its label, which makes rounds few on long
    chains too. Every round is written to the shared folder; both sides of each
    join are plain scans, so AQE can split a node that has most of the links.
    """
    both = stage(edges.union(edges.select("b", "a")).toDF("a", "b").distinct(), "links")
    labels = stage(both.select(F.col("a").alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    while True:
        sent = both.join(labels, both["a"] == labels["node"]).select(F.col("b").alias("node"), "label")
        least = stage(sent.union(labels.select("node", "label")).groupBy("node").agg(F.min("label").alias("label")), "labels")
        up = least.select(F.col("node").alias("__up"), F.col("label").alias("__label"))
        jumped = least.join(up, F.col("label") == F.col("__up")).select("node", F.col("__label").alias("label"))
        new = stage(jumped, "labels")
        old = labels.withColumnRenamed("label", "__old")
        if new.join(old, "node").where(F.col("label") != F.col("__old")).isEmpty():
            return new
        labels = new
