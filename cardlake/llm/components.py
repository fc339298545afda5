"""Connected components of an edge table by alternating large-star and small-star steps.

Every step is a grouped minimum and a join; the edge table never outgrows its first
size and shrinks to one edge per node, towards the component's smallest node, after
a number of rounds logarithmic in the component's size. Rounds are cut by tables
written to the shared scratch folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardlake.llm.tables import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges run from the larger node ``u`` to the smaller node ``v``."""
    if large:  # every larger neighbour moves to the smallest neighbour
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = around.groupBy("u").agg(F.min("v").alias("low")).select(
            F.col("u").alias("center"), F.least("u", "low").alias("low"))
        moved = edges.join(low, edges.v == low.center).select(F.col("u"), F.col("low").alias("v"))
    else:  # the node and its smaller neighbours move to the smallest of them
        low = edges.groupBy("u").agg(F.min("v").alias("low")).select(F.col("u").alias("center"), "low")
        near = edges.join(low, edges.u == low.center)
        moved = near.select(F.col("v").alias("u"), F.col("low").alias("v")).unionByName(
            low.select(F.col("center").alias("u"), F.col("low").alias("v")))
    return moved.where(F.col("u") != F.col("v")).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` for every node with an edge to another node; the component is named by
    its smallest node. Null ends, loops and repeated edges are ignored."""
    now = written(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    before = None
    while True:
        # the rounds have settled when the edge table no longer changes
        mark = now.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long")),
                       F.sum(F.xxhash64("v", "u").cast("decimal(38,0)"))).first()
        if mark == before or not mark[0]:
            break
        before = mark
        now = written(_star(_star(now, large=True), large=False), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
