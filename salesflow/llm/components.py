"""Connected components of a link table by alternating star contraction, all in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesflow.session import stage


def _smallest(links: DataFrame) -> DataFrame:
    """(node, low): each node's smallest neighbour or itself; minima are combined before the shuffle."""
    both = links.select("a", "b").unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lows = both.groupBy("a").agg(F.min("b").alias("low"))
    return lows.select(F.col("a").alias("node"), F.least("a", "low").alias("low"))


def components(links: DataFrame, rounds: int | None = None) -> DataFrame:
    """(node, component): the smallest node that ``links`` (a, b) reach, for every node that has a link.

    Each round points larger neighbours, then smaller ones, at a node's minimum,
    which keeps what is connected and about halves the longest path to the
    root; the written table of a round is the next one's input. The driver sees
    one answer per round. A node with very many links is split by the skew
    handling of the joins, both sides of which are written tables.

    After ``rounds`` the smallest neighbour so far is given: nodes of one
    component may then still differ, but equal ones are connected.
    """
    links = stage(links.where("a != b").select("a", "b").distinct(), "links")
    while True:
        low = stage(_smallest(links), "lows")
        both = links.unionAll(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("b > a")
        # every larger neighbour of a node to the node's minimum
        large = stage(both.join(low, both["a"] == low["node"]).select(F.col("b").alias("a"), F.col("low").alias("b")), "large-star")
        least = stage(large.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("low")), "minima")
        # a node and its other smaller neighbours to its minimum
        small = large.join(least, large["a"] == least["node"]).where("b != low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        links = stage(small.unionAll(least.select(F.col("node").alias("a"), F.col("low").alias("b"))).distinct(), "small-star")
        rounds = rounds and rounds - 1
        if rounds == 0:
            return _smallest(links).withColumnRenamed("low", "component")
        ends = links.select(F.col("a").alias("node"), "b").unionAll(links.select(F.col("b").alias("node"), F.lit(None).alias("b")))
        ends = ends.groupBy("node").agg(F.min("b").alias("least"), F.max("b").alias("most"), F.count(F.when(F.col("b").isNull(), 1)).alias("roots"))
        if ends.where("least != most OR (least IS NOT NULL AND roots > 0)").isEmpty():  # every node has one root, which has none
            return _smallest(links).withColumnRenamed("low", "component")
