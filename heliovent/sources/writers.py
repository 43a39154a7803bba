"""Writers of silver and gold tables, and of messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovent.operators.messages import as_messages
from heliovent.schemas import ACCEPTED, DAILY_PARTITIONS, PATTERN_PARTITIONS, REJECTED, SILVER_PARTITIONS
from heliovent.sources import folders


_OPEN_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def into_files(df: DataFrame, files: int | None) -> DataFrame:
    """Spread rows evenly over ``files`` tasks, hence files; None leaves them where they are.

    Rows are dealt out, not hashed: a run has a single ingestion date, and hashing by it would
    put the whole run into one task.
    """
    return df if files is None else df.repartition(files)


def by_folder(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Arrange a gold table for writing into one folder per combination of ``keys``.

    Folders of a city are small, since gold holds one row per city and day or per hour of a
    month, but there are many. Each becomes one file, and the number of tasks is fixed:
    adaptive execution looks at bytes only, and would leave one task to open all those files.

    Folders without the city may be large and uneven. Those are left to adaptive execution,
    which splits the big ones and merges the small ones.
    """
    if "ciudad" in keys:
        tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        return df.repartition(tasks, *keys)
    return df.hint("rebalance", *keys)


def write_silver(silver: DataFrame, path: str, files: int | None = None) -> None:
    """Append to silver, by ingestion date. ``files=1`` gives a single file per run."""
    into_files(silver, files).write.mode("append").partitionBy(*SILVER_PARTITIONS).parquet(path)


def _replace(table: DataFrame, path: str, keys: Sequence[str], versioned: bool) -> None:
    """Replace a table. A plain one is gone from the start of the write to its end; a versioned one is read as before until then."""
    spark = table.sparkSession
    version = folders.next_version(spark, path) if versioned else None
    # Static overwrite on purpose: partitions absent from the new table must go.
    writer = by_folder(table, keys).write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.partitionBy(*keys).parquet(f"{path.rstrip('/')}/{version}" if version else path)
    if version:
        folders.publish_version(spark, path, version)


def write_daily(daily: DataFrame, path: str, keys: Sequence[str] = DAILY_PARTITIONS, versioned: bool = False) -> None:
    """Replace the daily table. ``versioned``: in a folder of its own that becomes current once it is complete."""
    _replace(daily, path, keys, versioned)


def write_patterns(patterns: DataFrame, path: str, keys: Sequence[str] = PATTERN_PARTITIONS, versioned: bool = False) -> None:
    """Replace the patterns table. ``versioned``: see ``write_daily``.

    The default layout has a file of 24 rows per city and month. With many thousands of cities
    ``keys=["mes_anio"]`` is kinder to the file system; readers work with either.
    """
    _replace(patterns, path, keys, versioned)


def write_batch(rows: DataFrame, path: str, lote: str) -> None:
    """One batch of silver, accepted and rejected rows apart, to a folder of its own that a second attempt replaces.

    Each task keeps a file open for both kinds, so the rows are not sorted by kind.
    """
    kind = F.when(F.size("motivos") == 0, ACCEPTED).otherwise(REJECTED)
    conf = rows.sparkSession.conf
    before = conf.get(_OPEN_WRITERS)
    conf.set(_OPEN_WRITERS, "2")
    try:
        writer = rows.withColumn("estado", kind).write.mode("overwrite").option("partitionOverwriteMode", "static")
        writer.partitionBy("estado", *SILVER_PARTITIONS).parquet(f"{path.rstrip('/')}/lote={lote}")
    finally:
        conf.set(_OPEN_WRITERS, before)


def write_months(table: DataFrame, path: str, *more: str) -> None:
    """Replace the months that ``table`` holds (with ``more``: the months' parts) and leave the others."""
    keys = ("mes_anio", *more)
    writer = table.hint("rebalance", *keys).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*keys).parquet(path)


def write_by_time(silver: DataFrame, path: str, files: int, row_group_bytes: int = 16 << 20) -> None:
    """Silver laid out by time of observation: a file holds a stretch of time, and its row groups parts of it in order.

    Split points come from a sample that Spark takes of the times and cities, so files are even however observations crowd: a
    city or an hour with a third of all rows is spread over a third of the files. A filter on ``timestamp_epoch`` then skips
    files' row groups by their footers.
    """
    keys = ("timestamp_epoch", "ciudad")
    laid_out = silver.repartitionByRange(files, *keys).sortWithinPartitions(*keys)
    laid_out.write.mode("overwrite").option("parquet.block.size", row_group_bytes).parquet(path)


def publish(records: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Send records to a Kafka topic and wait for all replicas (needs the Kafka connector)."""
    writer = as_messages(records).write.format("kafka").options(**options)
    writer = writer.option("kafka.bootstrap.servers", servers).option("kafka.acks", "all")
    writer.option("topic", topic).save()
