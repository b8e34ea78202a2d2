"""Connected components by alternating large-star and small-star rounds, in Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorflow.llm.common import staged


def connected_components(nodes: DataFrame, edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, comp``: the smallest node reachable from each of ``nodes`` (column node) over ``edges`` (a, b).

    Each round hooks every node's larger neighbours, then its smaller ones, to the smallest node seen beside
    it (Kiveris et al., "Connected Components in MapReduce and Beyond"), O(log^2 n) rounds whatever the
    diameter. Minima are taken by partial aggregates and brought back by a join, so a hub's neighbours are
    never gathered in one place; each round is written to the shared folder to cut the lineage. Edges with a
    null end, loops and repeated edges are ignored.
    """
    edges = staged(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                   .distinct(), name)
    before = None
    while True:
        # large star: each node's larger neighbours go to the smallest of its neighbours and itself
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        big = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(big.filter("u <> v").distinct(), name)
        # small star: each node's smaller neighbours, and itself, go to the smallest of them
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(low, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")) \
            .unionByName(low.select("u", F.col("m").alias("v")))
        edges = staged(small.filter("u <> v").distinct(), name)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    return nodes.join(edges, nodes["node"] == edges["u"], "left") \
        .select("node", F.coalesce("v", "node").alias("comp"))
