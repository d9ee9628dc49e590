"""Connected components over edge tables, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.workspace import stored


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node, component`` (its smallest node) for every node of an edge.

    In each round a node points to the smallest among itself and its neighbours, and on to where that one
    points; then the graph is contracted to the nodes pointed to, so edges become fewer round by round. All tables
    are written to the shared folder; only the news that no edge is left reaches the driver.
    """
    some = edges.select(F.col(a).alias("node"), F.col(b).alias("near")).filter("node != near")
    edges = stored(some.union(some.select("near", "node")).distinct(), "edges")
    labels = None
    while True:
        if labels is not None and edges.isEmpty():
            return labels
        first = edges.groupBy("node").agg(F.least(F.col("node"), F.min("near")).alias("to"))
        first = stored(first, "pointers")
        second = first.select(F.col("node").alias("to"), F.col("to").alias("further"))
        to = stored(first.join(second, "to").select("node", F.col("further").alias("to")), "pointers")
        if labels is None:
            labels = to.withColumnRenamed("to", "component")
        else:
            step = to.withColumnRenamed("node", "component")
            labels = stored(labels.join(step, "component", "left").select("node", F.coalesce("to", "component").alias("component")), "labels")
        one = edges.join(to, "node").select(F.col("to").alias("node"), "near")
        two = one.join(to.select(F.col("node").alias("near"), F.col("to").alias("other")), "near").select("node", F.col("other").alias("near"))
        edges = stored(two.filter("node != near").distinct(), "edges")
