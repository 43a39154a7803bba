"""Stream of messages -> raw Parquet by day of observation.

The query keeps no state: a late message simply lands in the folder of its own day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from heliovent.operators.messages import MESSAGE_REASONS, add_day_partitions, judge_messages, parse_messages
from heliovent.plans.session import require_utc
from heliovent.schemas import RAW_PARTITIONS

DAILY_TRIGGER = "86400 seconds"
JUDGED_PARTITIONS = ("estado", *RAW_PARTITIONS)


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    **options: str,
) -> DataFrame:
    """Streaming source over one Kafka topic (needs the Kafka connector).

    Worth passing at scale: ``minPartitions`` splits a topic partition that holds most of the
    messages over several tasks, ``maxOffsetsPerTrigger`` bounds a batch after an outage.
    """
    reader = spark.readStream.format("kafka").options(**options)
    reader = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic)
    return reader.option("startingOffsets", starting_offsets).load()


def to_raw(messages: DataFrame) -> DataFrame:
    """Message frame (``value``) -> raw rows with their day partition; batch or streaming."""
    return add_day_partitions(parse_messages(messages))


COUNTS = "mensajes"


def to_judged(messages: DataFrame) -> DataFrame:
    """Message frame -> raw rows, accepted and rejected, counted on the way: ``message_counts`` reads the counts of a running query."""
    reasons = [F.count_if(F.array_contains("motivos", reason)).alias(reason) for reason in MESSAGE_REASONS]
    accepted = F.count_if(F.size("motivos") == 0).alias("aceptados")
    return judge_messages(messages).observe(COUNTS, F.count(F.lit(1)).alias("total"), accepted, *reasons)


def message_counts(query: StreamingQuery) -> dict[str, int]:
    """Messages seen, accepted, and rejected for each reason, over the batches that the query remembers (the last hundred)."""
    total: dict[str, int] = {}
    for progress in query.recentProgress:
        row = progress.observedMetrics.get(COUNTS)
        for name, count in (row.asDict() if row else {}).items():
            total[name] = total.get(name, 0) + count
    return total


def start_raw_sink(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    interval: str = DAILY_TRIGGER,
    files_per_batch: int | None = None,
    drain: bool = False,
    partitions: Sequence[str] = RAW_PARTITIONS,
) -> StreamingQuery:
    """Start appending ``raw`` to Parquet at ``path``; resumes from ``checkpoint``. Judged rows go by ``JUDGED_PARTITIONS``.

    A task sorts its rows by folder to write them, so they are dealt by folder first: adaptive execution merges small folders into
    one task and splits large ones between several. ``files_per_batch=1`` gives one file per batch and day, each written by one
    task; a larger number allows as many files of a day. ``drain=True`` processes what is there and stops.
    """
    if files_per_batch is None:
        rows = raw.hint("rebalance", *partitions)
    else:
        rows = raw.repartition(*partitions, F.pmod(F.xxhash64(*raw.columns), F.lit(files_per_batch)))
    writer = rows.writeStream.format("parquet").outputMode("append").partitionBy(*partitions)
    writer = writer.option("path", path).option("checkpointLocation", checkpoint)
    trigger = {"availableNow": True} if drain else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def run_raw_stream(
    spark: SparkSession,
    servers: str,
    topic: str,
    path: str,
    checkpoint: str,
    starting_offsets: str = "latest",
    source_options: dict[str, str] | None = None,
    **sink_options,
) -> None:
    """Topic to raw files until the query is stopped. ``source_options`` go to the topic's reader."""
    require_utc(spark)
    raw = to_raw(read_topic(spark, servers, topic, starting_offsets, **(source_options or {})))
    start_raw_sink(raw, path, checkpoint, **sink_options).awaitTermination()
