"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.common import forget, materialize


def connected_components(edges: DataFrame, u: str = "u", v: str = "v") -> DataFrame:
    """(node, component): component is the smallest node reachable.

    Nodes without an edge, and the smallest node of each component, are absent: they are their own component.

    Large-star links every larger neighbour of a node to the smallest node of its
    neighbourhood; small-star does so for smaller neighbours. Each round is two
    aggregations with map-side combine and two equi-joins. The aggregated side of a join is
    written first: then both sides are plain shuffles, and adaptive execution splits hot
    keys, which it does not do behind an aggregation. No neighbourhood is gathered in one
    place. Tables are written to the shared folder and deleted after the next round.
    Null ends and self-loops are ignored; an empty table gives an empty result.
    """
    spark = edges.sparkSession
    now = edges.select(F.greatest(u, v).cast("bigint").alias("u"), F.least(u, v).cast("bigint").alias("v")).where("u is not null and v is not null and u <> v").distinct()
    now, path = materialize(now, "cc")
    seen = _digest(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low, low_path = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large, large_path = materialize(large, "cc-large")
        low, least_path = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "cc-low")
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after, after_path = materialize(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "cc")
        digest = _digest(after)
        forget(spark, path, low_path, large_path, least_path)
        now, path, done, seen = after, after_path, digest == seen, digest
        if done:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
