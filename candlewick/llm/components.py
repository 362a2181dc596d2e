"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candlewick.session import Saved, save


def components(links: DataFrame, a: str, b: str) -> Saved:
    """(node, component): the smallest node each linked node reaches.

    Large-star and small-star steps in turn: every node hooks its larger
    neighbours (then its smaller ones) onto the smallest node it sees, until
    nothing changes (told by the number of edges and a 128-bit sum).  Each step
    is one aggregation and one join, both of which Spark can split for a node
    with very many links; the number of steps grows with the logarithm of the
    number of nodes.
    """
    edges = save(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "links")
    state = _fingerprint(edges.df)
    while True:
        # large star: larger neighbours of u to the least node that u sees
        both = edges.df.unionByName(edges.df.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = (both.where("v > u").join(least, "u").where("v <> m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        large_saved = save(large, "large-star")
        # small star: u and its smaller neighbours (after large star all edges point down) to the least of them
        down = large_saved.df
        low = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        new = save(small, "small-star")
        large_saved.drop()
        edges.drop()
        edges, before = new, state
        state = _fingerprint(edges.df)
        if state == before:
            break
    out = save(edges.df.select(F.col("u").alias("node"), F.col("v").alias("component"))
               .unionByName(edges.df.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()), "components")
    edges.drop()
    return out


def _fingerprint(edges: DataFrame) -> tuple:
    """Number of edges and sums of two hashes of each: one small aggregate
    tells whether a step has changed anything."""
    parts = [F.sum(F.xxhash64("u", "v", F.lit(salt)).cast("decimal(38,0)")) for salt in (1, 2)]
    return tuple(edges.agg(F.count(F.lit(1)), *parts).first())
