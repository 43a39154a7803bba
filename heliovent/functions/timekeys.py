"""UTC calendar keys by integer arithmetic on epoch seconds.

No text is parsed, and the result does not depend on the session time zone. Grouping keys
stay DATE and INT; texts such as ``2024-01`` are made once per group afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY = 86_400
HOUR = 3_600


def utc_date(epoch: Column) -> Column:
    return F.date_from_unix_date(F.floor(epoch / DAY).try_cast("int"))


def utc_hour(epoch: Column) -> Column:
    return F.floor(F.pmod(epoch, F.lit(DAY)) / HOUR).cast("int")


def month_start(date: Column) -> Column:
    return F.trunc(date, "month")


def hour_text(hour: Column) -> Column:
    return F.lpad(hour.cast("string"), 2, "0")


def month_text(date: Column) -> Column:
    return F.concat(year_text(date), F.lit("-"), _two(F.month(date)))


def year_text(date: Column) -> Column:
    return F.lpad(F.year(date).cast("string"), 4, "0")


def _two(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def utc_text(epoch: Column, between: str = " ", after: str = "") -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of epoch seconds, in UTC whatever the session zone."""
    date = utc_date(epoch)
    second = F.pmod(epoch, F.lit(HOUR)).cast("int")
    days = F.concat_ws("-", year_text(date), _two(F.month(date)), _two(F.day(date)))
    clock = F.concat_ws(":", hour_text(utc_hour(epoch)), _two(F.floor(second / 60)), _two(second % 60))
    # concat is NULL where a part is, unlike concat_ws
    return F.when(date.isNotNull(), F.concat(days, F.lit(between), clock, F.lit(after)))


def epoch_seconds(column: Column, unit: str) -> Column:
    """Whole epoch seconds from a column in ``unit`` (``s`` or ``ms``); the values do not decide."""
    if unit not in ("s", "ms"):
        raise ValueError(f"an epoch is in s or ms, not {unit}")
    return ((column / 1000) if unit == "ms" else column).try_cast("bigint")
