"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshore.llm.common import drop_saved, saved


def _checksum(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")),
                           F.bit_xor(F.xxhash64("v", "u", F.lit(1)))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a vertex points at the smallest neighbour."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (both.join(least, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """A vertex and its smaller neighbours point at the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return (edges.join(least, "u").where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionAll(least.select("u", F.col("m").alias("v"))).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(vertex, component): for every vertex of an edge, the smallest vertex it
    reaches. ``edges`` has two long columns u and v without nulls; loops,
    repeated edges and either direction are fine, and no edges give no rows.

    Alternating large-star and small-star rounds (O(log^2 n) of them): each is
    two aggregations and joins over the edge table, which never grows beyond
    its first size. The table is written to the shared folder after each round.
    """
    now = saved(edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                .distinct(), "edges")
    state = _checksum(now)
    while state[0]:
        after = saved(_small_star(_large_star(now)), "edges")
        previous, state = state, _checksum(after)
        drop_saved(now)
        now = after
        if state == previous:
            break
    # Only stars are left: each vertex points at its component's smallest.
    return (now.select(F.col("u").alias("vertex"), F.col("v").alias("component"))
            .unionAll(now.select(F.col("v").alias("vertex"), F.col("v").alias("component")).distinct()))
