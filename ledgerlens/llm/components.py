"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.session import stage

#: Rounds grow with the logarithm of the longest chain; this only stops a fault.
MAX_ROUNDS = 60


def _with_least(links: DataFrame) -> DataFrame:
    """Each link (u, v) with the least of u's neighbours, itself included. The least values are
    written first, so that both sides of the join are plain scans and a hub's rows can be split."""
    least = stage(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    return links.join(least.select("u", F.least("u", "m").alias("m")), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    links = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(links).where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    found = _with_least(edges)
    moved = found.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(found.select("u", F.col("m").alias("v"))).distinct()


def _sign(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node with a link to another; the component is its least node.

    Links with a null end and loops count for nothing. Every round is written to the shared
    folder. No table of a round is larger than twice the links.
    """
    edges = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(F.col(a).isNotNull() & F.col(b).isNotNull()).where("u != v")
    edges = stage(edges.distinct(), "edges")
    before = _sign(edges)
    for _ in range(MAX_ROUNDS):
        if not before[0]:
            break
        edges = stage(_small_star(_large_star(edges)), "stars")
        after = _sign(edges)
        if tuple(after) == tuple(before):
            break
        before = after
    else:
        raise RuntimeError("the components have not settled")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
