"""Connected components of a graph that is a DataFrame of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import Workspace


def connected_components(ws: Workspace, edges: DataFrame) -> DataFrame:
    """(node, root) of every node that is not its component's least node.

    Alternates large-star and small-star steps (each node hangs its larger,
    then its smaller neighbours on the least one) until the edges are stars
    around the least nodes.  Every step is written out, so a lost executor
    costs no more than the step at hand.
    """
    step = 0

    def table(df: DataFrame) -> DataFrame:
        nonlocal step
        step += 1
        return ws.table(df, f"components-{step}")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("node", "root").cast("decimal(38,0)"))).first())

    stars = table(edges.select(F.greatest("src", "dst").alias("node"), F.least("src", "dst").alias("root"))
                  .where("node != root").distinct())
    before = None
    while before != (now := state(stars)):
        before = now
        ws.remove(*(f"components-{k}" for k in range(1, step)))  # the stars alone go on
        both = stars.unionByName(stars.selectExpr("root as node", "node as root"))
        least = table(both.groupBy("node").agg(F.least(F.min("root"), F.col("node")).alias("least")))
        large = table(both.where("root > node").join(least, "node").selectExpr("root as node", "least as root").distinct())
        least = table(large.groupBy("node").agg(F.min("root").alias("least")))
        small = large.join(least, "node").where("root != least").selectExpr("root as node", "least as root")
        stars = table(small.unionByName(least.withColumnRenamed("least", "root")).distinct())
    return stars
