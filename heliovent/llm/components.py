"""Connected components of a graph given by edges, in rounds of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovent.llm.storage import stored


def _signature(edges: DataFrame):
    return tuple(edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())


def components(edges: DataFrame) -> DataFrame:
    """edges (a, b) -> node, component: the smallest node reachable. Nodes without an edge are not returned.

    Alternates two star contractions: every node hands its larger neighbours, then its smaller ones, to the
    smallest node it sees. Minima are aggregated before the shuffle and joined back one row per node, so a node
    with very many edges is no group of its own. Each round is written to the shared folder.
    """
    seen = stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    was, now = None, _signature(seen)
    while now != was and now[0]:
        both = seen.union(seen.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        larger = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = larger.groupBy("u").agg(F.min("v").alias("m"))
        smaller = larger.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        seen = stored(smaller.union(least).distinct())
        was, now = now, _signature(seen)
    roots = seen.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return seen.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
