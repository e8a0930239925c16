"""Connected components by alternating large-star and small-star steps, all in DataFrames.

Each step needs for every node the least of its neighbours, a partially aggregated minimum, and one
join of the edges with these; the join may be skewed at a hub and is left splittable. Edges never
reach the driver; only their number and a checksum do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
    return row["n"], row["h"]


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every node of edges(u, v) with u <> v; component is the least id reachable.

    Repeated edges count once; without edges the result is empty; a null end is no edge.
    """
    star = materialise(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = _digest(star)
    while True:
        both = star.select("u", "v").union(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialise(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        star = materialise(small, star, large)
        now = _digest(star)
        if now == seen:
            break
        seen = now
    return star.select(F.col("u").alias("id"), F.col("v").alias("component")).union(star.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
