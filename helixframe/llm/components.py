"""Connected components by alternating large and small stars, all in joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import materialize


def _mins(edges: DataFrame) -> DataFrame:
    """edges (u, v) with, for each u, the least of u and its neighbours."""
    m = edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return edges.join(m, "u")


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of links (a, b) that isn't its component's least node."""
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, state = materialize(edges, "links"), None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _mins(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small = _mins(large)
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(small.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = materialize(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now
