"""Connected components of a link table, by DataFrame joins: least-neighbour hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.llm._spark import Scratch


def connected_components(links: DataFrame, spark: SparkSession, *, a: str = "a", b: str = "b", most_rounds: int = 60) -> DataFrame:
    """(node, component) for each node of the links; component is the least node that can be reached.

    Each round hooks every node's label to the least label in its neighbourhood and follows labels once, so the
    distance to the least node halves about once a round.  A round's result is written to the shared folder; labels are
    pre-aggregated on the map side, so a hub costs one row for each task.  Tables of earlier rounds are deleted.
    """
    scratch = Scratch(spark)
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = scratch.stored(edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), ids=True)
    labels = edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m")).select("node", F.least("node", "m").alias("component"))
    labels = scratch.stored(labels, ids=True)
    table = labels
    for _ in range(most_rounds):
        near = edges.join(labels, edges.v == labels.node).groupBy(F.col("u").alias("node")).agg(F.min("component").alias("m"))
        low = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "m").alias("low"))
        # The old label learns of the lower one, so whole trees move together.
        hook = low.where("low < was").groupBy(F.col("was").alias("node")).agg(F.min("low").alias("m"))
        moved = low.join(hook, "node", "left").select("node", "was", F.least("low", F.coalesce("m", "low")).alias("low"))
        jump = moved.select(F.col("node").alias("low"), F.col("low").alias("next"))
        new = scratch.stored(moved.join(jump, "low", "left").select("node", "was", F.least("low", F.coalesce("next", "low")).alias("component")), ids=True)
        if new.where("was <> component").isEmpty():
            scratch.close(table)
            return labels
        scratch.close(edges, new)
        table, labels = new, new.select("node", "component")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
