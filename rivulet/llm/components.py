"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rivulet.session import materialize, release


def connected_components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b); root is the smallest node it reaches.

    A large-star step links every larger neighbour of a node to the smallest one around it, a small-star
    step does so for the smaller ones. Both only replace links, so the table never holds more rows than
    links and nodes together; rounds grow with the logarithm of the longest chain. Each round is written
    to the shared folder, which ends its lineage, and the round before is removed. Links from a node to itself and repeated ones are harmless.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).filter("high <> low").distinct(), "links")
    nodes = edges
    state = None
    for _ in range(most_rounds):
        before, edges = edges, materialize(_small_star(_large_star(edges)), "links")
        if before is not nodes:
            release(before)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("high", "low").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    every = nodes.select(F.explode(F.array("high", "low")).alias("node")).distinct()
    return every.join(edges.select(F.col("high").alias("node"), F.col("low").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("root")
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("high", "low").union(edges.select("low", "high")).toDF("node", "other")
    smallest = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    larger = both.filter("other > node").join(smallest, "node")
    return larger.select(F.col("other").alias("high"), F.col("least").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("high").agg(F.min("low").alias("least"))
    joined = edges.join(smallest, "high")
    onto_least = joined.filter("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return onto_least.union(smallest.select("high", F.col("least").alias("low"))).distinct()
