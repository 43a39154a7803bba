"""What the jobs ask of a session. Everything else is the caller's choice."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings the jobs are written for; pass them to the session builder.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",  # files of checkpoints go with their frames
}


def require_utc(spark: SparkSession) -> None:
    """Date texts are made in the session zone, and the tables promise UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")


def ensure_checkpoint_dir(spark: SparkSession, fallback: str) -> None:
    """Use the cluster's checkpoint folder; only where none is named, use ``fallback``."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or fallback)
