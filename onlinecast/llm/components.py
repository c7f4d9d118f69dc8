"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from onlinecast.llm.common import Scratch


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))


def _large_star(edges: DataFrame) -> DataFrame:
    """Link every larger neighbour of a node to the smallest node around it."""
    around = _both_ways(edges)
    least = around.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return around.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Link every smaller neighbour of a node, and the node, to the smallest of them. Needs u > v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """Smallest node ``component`` reachable from each ``node`` that has a link.

    ``edges`` has u and v; direction, repeats and loops do not matter. Every round is two joins on a table
    written to the shared folder; the number of rounds grows with the logarithm of the longest path.
    """
    scratch = Scratch(edges.sparkSession, "components")
    now = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    now, round_no, before = scratch.write(now, "edges0"), 0, None
    while True:
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if mark["n"] == 0 or tuple(mark) == before:
            break
        before = tuple(mark)
        round_no += 1
        stars = _large_star(now).where("u <> v").distinct()
        now = scratch.write(_small_star(stars).distinct(), f"edges{round_no}")
        scratch.drop(f"edges{round_no - 1}")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
