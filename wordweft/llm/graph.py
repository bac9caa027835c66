"""Connected components of an edge table, without a window or a group over a whole component."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import keep


def components(edges: DataFrame) -> DataFrame:
    """Edges (a, b) of bigint nodes -> (node, root), root being the smallest node of the component.

    Every edge points from its larger to its smaller end. A round hooks each node to its smallest
    neighbour and hands its other neighbours on to that one, until each node has one smaller neighbour;
    then parents are doubled. A hub is the smaller end of its edges, so no group grows with a component.
    Each round is written to the shared folder. A component's root is a row too.
    """
    links = keep(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    while True:
        hooked = links.withColumn("m", F.min("b").over(Window.partitionBy("a")))
        passed_on = hooked.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = keep(hooked.select("a", F.col("m").alias("b")).unionByName(passed_on).distinct(), "links")
        done = after.groupBy("a").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
        links = after
        if done:
            break
    parents = links.toDF("node", "root")
    while True:
        above = parents.toDF("root", "above")
        jumped = keep(
            parents.join(above, "root", "left")
            .select("node", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "parents")
        parents = jumped.select("node", "root")
        if jumped.where("moved").isEmpty():
            break
    return parents.unionByName(parents.select(F.col("root").alias("node"), "root").distinct())
