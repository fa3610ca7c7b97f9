"""Connected components of a link table, entirely in DataFrames.

Alternating large-star and small-star steps: every step replaces a node's
links by links to the smallest node it sees, so the table never grows past
one row per (node, neighbour) and ends as one star per component. Each round
is aggregates and joins keyed by node, written to the shared folder; only a
row count and a checksum reach the driver. A star centre with very many links
is pre-aggregated by ``min`` before its shuffle and joined as the many side
of an equi-join, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import by_key, cut


def _checksum(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                  F.sum(F.xxhash64("v", "u") % 1_000_003).alias("s")).first()
    return r["n"], r["x"], r["s"]


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return (both.join(by_key(low), "u").where(F.col("v") > F.col("u"))
                .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = (edges.join(by_key(low), "u").where(F.col("v") != F.col("m"))
                  .select(F.col("v").alias("u"), F.col("m").alias("v")))
    return moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """``links`` (u, v of one orderable type) to (node, component): every node
    that has a link to another node, with the smallest node it can reach.

    Self links and rows with a null end are ignored; repeated and reversed
    links count once; no links give no rows. Nodes without a link are not
    listed, they are their own component."""
    edges = (links.where(F.col("u").isNotNull() & F.col("v").isNotNull()
                         & (F.col("u") != F.col("v")))
                  .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    edges = cut(edges, name)
    before = _checksum(edges)
    while before[0]:
        edges = cut(_small_star(_large_star(edges)), name)
        after = _checksum(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
