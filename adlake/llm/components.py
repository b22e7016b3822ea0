"""Connected components by distributed union-find: links are rehung to smaller ids until every component is a star.

Each round is two aggregations with a combine before the shuffle and two joins whose hot keys adaptive execution splits;
its result is written to the shared folder. Rounds grow with the logarithm of the longest chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.session import cut_lineage


def large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of an id to the smallest of its neighbours and itself. ``edges``: u > v."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("_m")).select(F.col("u").alias("_u"), F.least("u", "_m").alias("_m"))
    larger = both.where("v > u")
    return larger.join(cut_lineage(least), F.col("u") == F.col("_u")).select(F.col("v").alias("u"), F.col("_m").alias("v")).distinct()


def small_star(edges: DataFrame) -> DataFrame:
    """Hang every smaller neighbour of an id, and the id, to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("_m")).withColumnRenamed("u", "_u")
    least = cut_lineage(least)
    moved = edges.join(least, F.col("u") == F.col("_u")).where("v != _m").select(F.col("v").alias("u"), F.col("_m").alias("v"))
    return moved.unionByName(least.toDF("u", "v")).distinct()


def all_stars(edges: DataFrame) -> bool:
    """Whether every id hangs to one other, which hangs to none."""
    hung = edges.groupBy("u").agg(F.count("*").alias("_n"))
    twice = hung.where("_n > 1").select("u")
    chained = edges.join(hung.select(F.col("u").alias("_u")), F.col("v") == F.col("_u"), "left_semi").select("u")
    return twice.unionByName(chained).isEmpty()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id that has a link; component is the smallest id reachable."""
    wide = links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    edges = cut_lineage(wide.distinct())
    while not all_stars(edges):
        edges = cut_lineage(small_star(cut_lineage(large_star(edges))))
    roots = edges.select(F.col("v").alias("id")).distinct()
    return edges.toDF("id", "component").unionByName(roots.select("id", F.col("id").alias("component")))
