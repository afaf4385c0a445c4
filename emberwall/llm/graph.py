"""Connected components of a link table by alternating star contraction.

Every round rewrites the links so that nodes point to smaller ones, until each
node points to the smallest of its component. A hub's links are aggregated
before they are shuffled, and the joins can be split where one node is hot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import cut_lineage


def _hook(links: DataFrame) -> DataFrame:
    """Rows (u, v) to (v, m) with m the smallest of u and its v; u itself points to m as well."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = links.join(least, "u")
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))


def _round(links: DataFrame) -> DataFrame:
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _hook(both).where("u > v").distinct()
    return _hook(large).where("u > v").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node that has a link; component is its smallest reachable node.

    ``links`` has two columns of one type; loops, repeats and nulls are ignored.
    """
    a, b = links.columns
    pairs = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))).distinct()
    pairs, seen = cut_lineage(pairs), None
    while True:
        # a round that leaves the links as they are ends it: they then form stars around the smallest nodes
        state = pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("u", "v") % 65521)).first()
        if state == seen or not state[0]:
            break
        pairs, seen = cut_lineage(_round(pairs)), state
    stars = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.union(stars.select(F.col("component").alias("node"), "component").distinct())
