"""Connected components of an undirected edge table, as repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(id, component)``: the least vertex reachable from each vertex.

    Every round gives a vertex the least label among its neighbours and then the label
    of that label, so the rounds needed grow with the logarithm of the longest chain of
    labels, and a row for each vertex and each edge is all that is moved.  Null ends and
    loops are ignored; no edges give no rows.
    """
    both = edges.where("a is not null and b is not null and a <> b")
    both = written(both.select("a", "b").union(both.select("b", "a")).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("component")).withColumnRenamed("a", "id"), "labels")
    while True:
        near = both.join(labels.select(F.col("id").alias("b"), "component"), "b").groupBy("a").agg(F.min("component").alias("near"))
        least = labels.join(near.withColumnRenamed("a", "id"), "id").select("id", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        least = written(least, "labels")
        jump = least.select(F.col("id").alias("component"), F.col("component").alias("further"))
        after = written(least.join(jump, "component").select("id", "old", F.least("component", "further").alias("component")), "labels")
        if after.where("component <> old").isEmpty():
            return after.select("id", "component")
        labels = after.select("id", "component")
