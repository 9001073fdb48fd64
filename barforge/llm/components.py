"""Connected components of a link table, by label propagation with jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barforge.llm.common import materialise


def connected_components(links: DataFrame) -> DataFrame:
    """``node``, ``component`` (the least node of the component) for links (a, b).

    First each node is replaced by the least of itself and its neighbours.
    That keeps components and their least nodes, and leaves few distinct links
    of a dense group, so that the rounds read few rows.
    """
    links = materialise(links.select("a", "b").where("a <> b").distinct(), "links")
    ends = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    near = materialise(ends.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("least")), "least")
    met = links
    for end in "ab":
        met = met.join(near.toDF(end, "least"), end).drop(end).withColumnRenamed("least", end)
    found = _propagated(met).toDF("least", "component")
    return near.join(found, "least", "left").select("node", F.coalesce("component", "least").alias("component"))


def _propagated(links: DataFrame) -> DataFrame:
    """The components of contracted links.

    Every round hands each node the least label among its neighbours, then
    that label's own label (a jump).  Rounds end when no label changes; each
    is written to the shared folder.  A node with very many links is handled
    by partial aggregation and by the splitting of skewed joins.
    """
    both = links.select(F.col("a").alias("node"), F.col("b").alias("other")).where("node <> other")
    both = materialise(both.unionByName(both.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "links")
    labels = materialise(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("component")), "labels")
    while True:
        heard = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("component").alias("heard"))
        least = labels.join(heard, "node").select(
            "node", F.least("component", "heard").alias("least"), F.col("component").alias("before")
        )
        jump = labels.select(F.col("node").alias("least"), F.col("component").alias("further"))
        moved = least.join(jump, "least", "left").select(
            "node", "before", F.least("least", F.coalesce("further", "least")).alias("component")
        )
        moved = materialise(moved, "labels")
        labels = moved.select("node", "component")
        if moved.where("component <> before").isEmpty():
            return labels
