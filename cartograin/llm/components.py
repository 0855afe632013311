"""Connected components of an edge table, by label propagation and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged


def components(edges: DataFrame) -> DataFrame:
    """node, component (smallest node reachable) for every node of ``edges`` (a, b).

    Each round takes the least label among neighbours and then the label of the label;
    rounds are few because labels jump. Labels are written to the shared folder after
    each round; aggregation is partial, so a node of any degree is no hot key.
    """
    both = edges.select(F.col("a").alias("node"), F.col("b").alias("other")).unionByName(edges.select(F.col("b").alias("node"), F.col("a").alias("other")))
    both = staged(both.filter("node != other"), "component-edges")
    labels = staged(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("component")), "component-labels")
    while True:
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("component").alias("near"))
        joined = labels.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        moved = joined.join(jump, "component").select("node", "old", F.least("component", "further").alias("component"))
        moved = staged(moved.select("node", "component", (F.col("old") != F.col("component")).alias("changed")), "component-labels")
        labels = moved.drop("changed")
        if moved.filter("changed").isEmpty():
            return labels


def merged(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """Labels after more edges: components of the edges between labels, applied to the labels there were."""
    if labels is None:
        return components(edges)
    a = edges.join(labels.select(F.col("node").alias("a"), F.col("component").alias("la")), "a", "left")
    a = a.join(labels.select(F.col("node").alias("b"), F.col("component").alias("lb")), "b", "left")
    between = a.select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).filter("a != b")
    joined = components(between).select(F.col("node").alias("component"), F.col("component").alias("to"))
    kept = labels.join(joined, "component", "left").select("node", F.coalesce("to", "component").alias("component"))
    fresh = joined.select(F.col("component").alias("node"), F.col("to").alias("component")).join(labels.select("node"), "node", "left_anti")
    return staged(kept.unionByName(fresh), "component-merged")
