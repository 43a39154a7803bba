"""Samples of a fixed size, whatever the number of rows and however often one of them is repeated."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def least_hashes(rows: DataFrame, size: int, groups: list[str]) -> DataFrame:
    """``size`` rows of each group, or all of a smaller one: those with the least hashes of doc_id and text.

    Each task keeps ``size`` hashes of a group, so what is shuffled to find the largest hash taken is small; texts follow
    only for rows up to it. Rows that are equal in both share a hash, and as many of them are taken as there is room for.
    """
    hashed = rows.withColumn("_hash", F.xxhash64("doc_id", "text"))
    group = Window.partitionBy(*groups, F.lit(0))  # the constant: also for no groups at all
    ranked = hashed.select(*groups, "_hash").withColumn("_rank", F.row_number().over(group.orderBy("_hash")))
    last = ranked.where(F.col("_rank") <= size).groupBy(*groups, F.lit(0).alias("_one")).agg(F.max("_hash").alias("_last"))
    near = hashed.withColumn("_one", F.lit(0)).join(F.broadcast(last), [*groups, "_one"]).where("_hash <= _last")
    chosen = near.withColumn("_rank", F.row_number().over(group.orderBy("_hash"))).where(F.col("_rank") <= size)
    return chosen.select(*rows.columns)
