"""Weather observations to wind and solar potential, as Spark jobs."""

from heliovent.plans.compaction import compact
from heliovent.plans.increments import BatchRun, run_gold_increment, run_silver_increment
from heliovent.plans.jobs import SilverRun, chart_tables, run_gold, run_medallion, run_report, run_silver
from heliovent.streaming.raw import run_raw_stream

__all__ = [
    "BatchRun",
    "SilverRun",
    "chart_tables",
    "compact",
    "run_gold",
    "run_gold_increment",
    "run_medallion",
    "run_raw_stream",
    "run_report",
    "run_silver",
    "run_silver_increment",
]
