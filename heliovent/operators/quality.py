"""Row-level quality rule, its metrics, and the gate on empty tables."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


class EmptyTableError(RuntimeError):
    """A stage was about to work on, or write, a table without rows."""


# What a valid row must know (silver columns), and the reason given for a row that does not.
REASONS = {"ciudad": "sin_ciudad", "temperatura_c": "sin_temperatura", "timestamp_epoch": "sin_fecha"}


def is_valid() -> Column:
    """City, temperature and time are all known (silver columns)."""
    return reduce(and_, (F.col(name).isNotNull() for name in REASONS))


def reasons() -> Column:
    """All reasons to reject a row, in the order of the rules; none for a valid one."""
    return F.array_compact(F.array(*[F.when(F.col(name).isNull(), F.lit(reason)) for name, reason in REASONS.items()]))


def keep_valid(silver: DataFrame) -> DataFrame:
    return silver.filter(is_valid())


def _counts() -> list[Column]:
    total = F.count(F.lit(1))
    clean = F.count_if(is_valid())
    return [
        total.alias("total_rows"),
        clean.alias("clean_rows"),
        (total - clean).alias("rejected_rows"),
    ]


def _counts_by_reason() -> list[Column]:
    return [F.count_if(F.array_contains("motivos", reason)).alias(reason) for reason in REASONS.values()]


def observe_reasons(judged: DataFrame, observation: Observation) -> DataFrame:
    """All rows, counted on the way: seen, kept, rejected, and rejected for each reason (a row may have several)."""
    return judged.observe(observation, *_counts(), *_counts_by_reason())


def quality_metrics(silver: DataFrame) -> DataFrame:
    """One row: rows seen, kept and rejected, counted in one pass."""
    return silver.agg(*_counts())


def observe_quality(silver: DataFrame, observation: Observation) -> DataFrame:
    """``keep_valid`` that counts on the way, so a write needs no extra scan for its metrics.

    Put it after the last shuffle: a task of the final stage is counted once, whereas tasks
    of a shuffle stage that are rerun for a lost executor would be counted again.
    """
    return keep_valid(silver.observe(observation, *_counts()))


def require_rows(df: DataFrame, what: str) -> None:
    """Raise unless ``df`` has a row; stops reading at the first one."""
    if df.isEmpty():
        raise EmptyTableError(f"{what} holds no rows")
