"""Connected components by contraction, in joins and groupings that split hot nodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import Workspace


def components(edges: DataFrame, work: Workspace, name: str = "components") -> DataFrame:
    """``node, component`` for every node of an edge ``a, b`` (long); a component is its least node.

    Each round points every node at its least neighbour, follows the pointers four steps, and puts
    the ends of the edges in the nodes' place. A component's least node always points at itself, so
    the last name standing is the least. Even a chain shrinks to a quarter in a round. Tables are
    written every round; minima are taken in each task before the shuffle. Null ends are no edges.
    """
    def saved(frame: DataFrame, what: str, at: int) -> DataFrame:
        return work.save(frame, f"{name}-{what}-{at}")

    edges = saved(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))
                  .where("a <> b").distinct(), "edges", 0)
    labels = None
    at = 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = saved(both.groupBy("a").agg(F.min("b").alias("b"))
                      .select("a", F.least("a", "b").alias("to")), "least", at)
        for step in ("two", "four"):
            onward = least.select(F.col("a").alias("to"), F.col("to").alias("next"))
            least = saved(least.join(onward, "to", "left")
                          .select("a", F.coalesce("next", "to").alias("to")), step, at)
        if labels is None:
            named = least.select(F.col("a").alias("node"), F.col("to").alias("component"))
        else:
            named = (labels.join(least.withColumnRenamed("a", "component"), "component", "left")
                     .select("node", F.coalesce("to", "component").alias("component")))
        labels = saved(named, "labels", at + 1)
        ends = least.select("a", F.col("to").alias("a2"))
        other = least.select(F.col("a").alias("b"), F.col("to").alias("b2"))
        joined = edges.join(ends, "a").join(other, "b").where("a2 <> b2")
        new = saved(joined.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b"))
                    .distinct(), "edges", at + 1)
        work.drop(*(f"{name}-{what}-{at}" for what in ("edges", "least", "two", "four", "labels")))
        edges, at = new, at + 1
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
