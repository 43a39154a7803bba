"""API payloads -> flat stream records -> messages."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovent.functions.timekeys import utc_date, utc_text, year_text
from heliovent.schemas import ACCEPTED, REJECTED, STREAM_RECORD

# The parts of the API answer that are used; their entries are all numbers. Maps, because a key
# that is absent must be told apart from one that is null.
_PAYLOAD = (
    "name STRING, dt BIGINT, "
    "coord MAP<STRING, DOUBLE>, main MAP<STRING, DOUBLE>, wind MAP<STRING, DOUBLE>"
)

# Keys without which an answer cannot become a record.
_REQUIRED = {"coord": ("lat", "lon"), "main": ("temp", "humidity", "pressure"), "wind": ("speed",)}


def normalise_payload(
    payloads: DataFrame,
    column: str = "payload",
    source: str = "openweather",
    now_ms: Column | None = None,
) -> DataFrame:
    """Raw JSON answers -> stream records; answers that lack a needed part give no record.

    ``ts`` is the time of polling in milliseconds (``now_ms``, default: now), while
    ``datetime_utc`` is the time of the observation.
    """
    now_ms = F.unix_millis(F.current_timestamp()) if now_ms is None else now_ms
    # As a generated row the parsed answer is computed once; a plain column would be parsed
    # again for each condition, since filters are pushed below projections.
    parsed = payloads.select(F.inline(F.array(F.from_json(F.col(column), _PAYLOAD))))
    complete = F.col("dt").isNotNull()
    for part, keys in _REQUIRED.items():
        for key in keys:
            complete = complete & F.map_contains_key(F.col(part), key)

    def number(part: str, key: str) -> Column:
        return F.try_element_at(F.col(part), F.lit(key))

    return parsed.filter(complete).select(
        F.lit(source).alias("source"),
        F.col("name").alias("city"),
        number("coord", "lat").alias("lat"),
        number("coord", "lon").alias("lon"),
        now_ms.cast("bigint").alias("ts"),
        utc_text(F.col("dt"), "T", "Z").alias("datetime_utc"),
        number("main", "temp").alias("temp_c"),
        number("main", "humidity").alias("humidity"),
        number("main", "pressure").alias("pressure"),
        number("wind", "speed").alias("wind_speed"),
    )


def as_messages(records: DataFrame) -> DataFrame:
    """One UTF-8 JSON message per record in a binary ``value``; NULL fields are written as null."""
    record = F.struct(*records.columns)
    body = F.to_json(record, {"ignoreNullFields": "false"})
    return records.select(body.cast("binary").alias("value"))


def parse_messages(messages: DataFrame) -> DataFrame:
    """Messages with a ``value`` -> stream records.

    A message that is not JSON becomes a row of NULLs; a field of the wrong type becomes NULL
    and leaves the others as they are.
    """
    body = F.col("value").cast("string")
    parsed = F.from_json(body, STREAM_RECORD, {"mode": "PERMISSIVE"})
    return messages.select(parsed.alias("data")).select("data.*")


# Reasons to reject a message, in the order in which they are given.
MESSAGE_REASONS = ("sin_json", "sin_fecha", "sin_ciudad")


def judge_messages(messages: DataFrame) -> DataFrame:
    """Stream records with their day, the reasons to reject each (``motivos``), its state and, of a rejected one, the message itself."""
    body = F.col("value").cast("string")
    rows = messages.select(F.from_json(body, STREAM_RECORD, {"mode": "PERMISSIVE"}).alias("data"), body.alias("mensaje")).select("data.*", "mensaje")
    dated = add_day_partitions(rows)
    unknown = reduce(and_, (F.col(name).isNull() for name in STREAM_RECORD.fieldNames()))
    broken = {
        "sin_json": unknown & F.try_parse_json("mensaje").isNull(),
        "sin_fecha": F.col("day").isNull(),
        "sin_ciudad": F.col("city").isNull(),
    }
    judged = dated.withColumn("motivos", F.array_compact(F.array(*[F.when(broken[reason], F.lit(reason)) for reason in MESSAGE_REASONS])))
    accepted = F.size("motivos") == 0
    return judged.withColumns({"estado": F.when(accepted, ACCEPTED).otherwise(REJECTED), "mensaje": F.when(~accepted, F.col("mensaje"))})


def add_day_partitions(records: DataFrame) -> DataFrame:
    """``year``, ``month``, ``day`` of the observation in UTC as zero-padded text; NULL if unreadable.

    A time without a zone is taken as UTC.
    """
    text = F.col("datetime_utc")
    zoned = F.when(text.rlike(r"(Z|[+-]\d{1,2}(:?\d{2})?|[A-Za-z]{3,})\s*$") & ~text.rlike(r"^\s*\d{4}-\d{1,2}(-\d{1,2})?\s*$"), text)
    date_only = F.when(text.rlike(r"^\s*\d{4}(-\d{1,2}){0,2}\s*$"), F.concat(text, F.lit("T00:00:00Z")))
    observed = F.coalesce(F.try_to_timestamp(zoned), F.try_to_timestamp(F.concat(F.trim(text), F.lit("Z"))), F.try_to_timestamp(date_only))
    date = utc_date(F.unix_seconds(observed))
    return records.withColumns({"year": year_text(date), "month": F.lpad(F.month(date).cast("string"), 2, "0"), "day": F.lpad(F.day(date).cast("string"), 2, "0")})
