"""Many small files of a partitioned table become few of about a target size, folder by folder and without a shuffle."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliovent.schemas import SILVER, SILVER_PARTITIONS

log = logging.getLogger(__name__)


def crowded_folders(spark: SparkSession, path: str, target_bytes: int) -> DataFrame:
    """folder, files and bytes of the folders in which several files are below half the target, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    folder = F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("folder")
    sizes = files.select(folder, "length").groupBy("folder").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.count_if(F.col("length") < target_bytes / 2).alias("small")
    )
    return sizes.where("small > 1").select("folder", "files", "bytes")


def packed(spark: SparkSession, folder: str, schema: T.StructType, target_bytes: int) -> DataFrame:
    """A folder's rows with about ``target_bytes`` of its files to a task; Spark's scan does the packing, nothing is shuffled."""
    session = spark.newSession()  # these settings are for this read alone
    for name, value in (("maxPartitionBytes", target_bytes), ("openCostInBytes", 0), ("minPartitionNum", 1)):
        session.conf.set(f"spark.sql.files.{name}", value)
    return session.read.schema(schema).parquet(folder)


def compact(spark: SparkSession, path: str, target_bytes: int = 128 << 20, schema: T.StructType = SILVER, keys: Sequence[str] = SILVER_PARTITIONS) -> list[str]:
    """Rewrite the folders of a table whose files are small; returns their names below ``path``.

    Each folder is written aside and then takes the place of the old one, so a fault leaves a folder as it was or as it shall
    be, but for the moment of the exchange. A second run finds nothing to do. Rows written to a folder meanwhile would be lost:
    run it where no other job appends to the same day.
    """
    own = T.StructType([f for f in schema if f.name not in keys])
    done = []
    for row in crowded_folders(spark, path, target_bytes).toLocalIterator():
        names = row["folder"].rsplit("/", len(keys))[1:]
        values = dict(name.split("=", 1) for name in names)
        constants = {key: F.lit(unquote(values[key])).cast(schema[key].dataType) for key in keys}
        rows = packed(spark, row["folder"], own, target_bytes).withColumns(constants)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)
        done.append("/".join(names))
        log.info("compacted %s: %d files, %d bytes", done[-1], row["files"], row["bytes"])
    return sorted(done)
