"""Connected components of an undirected graph, by labels that spread and jump."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.common import tasks_for, written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of the edges (a, b); label is its component's least node.

    Each round, a node takes the least label among its neighbours, then the label of that
    label, so chains halve. Labels are written between rounds; only counts reach the driver.
    The edges are read twice, and no round has more tasks than their number calls for. Loops and repeated edges are allowed, null ends are ignored. No edges, no rows.
    """
    pairs = edges.where("a IS NOT NULL AND b IS NOT NULL").select("a", "b")
    n = tasks_for(pairs)
    both = written(pairs.union(pairs.select("b", "a")).distinct().coalesce(n), "links")
    labels = written(both.groupBy("a").agg(F.least("a", F.min("b")).alias("label"))
                     .withColumnRenamed("a", "node").coalesce(n), "labels")
    while True:
        near = (both.join(labels, both.b == labels.node).coalesce(n).groupBy("a")
                .agg(F.min("label").alias("near")))
        spread = (labels.join(near, labels.node == near.a)
                  .select("node", F.least("label", "near").alias("low"), "label").coalesce(n))
        up = labels.select(F.col("node").alias("low"), F.col("label").alias("top"))
        jumped = written(spread.join(up, "low").select(
            "node", F.least("low", "top").alias("label"),
            (F.least("low", "top") < F.col("label")).alias("moved")).coalesce(n), "labels")
        labels = jumped.select("node", "label")
        if jumped.where("moved").isEmpty():
            return labels
