"""The silver table: stamps, final projection, preview, latest copy of each observation."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovent.functions.timekeys import utc_text
from heliovent.schemas import SILVER, SILVER_PARTITIONS

# The columns that are the same for all rows of a run, last in the silver schema.
STAMPS = ("fecha_procesamiento_utc", *SILVER_PARTITIONS)

# Normalised name -> silver name, where they differ.
SILVER_NAMES = {
    "dt": "timestamp_epoch",
    "uv_index": "indice_uv",
    "snow_1h_mm": "nieve_1h_mm",
    "rain_1h_mm": "lluvia_1h_mm",
    "city_name": "ciudad",
}

# The columns shown after a run.
PREVIEW_COLUMNS = (
    "ciudad",
    "timestamp_iso",
    "temperatura_c",
    "lluvia_1h_mm",
    "nieve_1h_mm",
    "clima_descripcion_corta",
    "clima_descripcion_larga",
)


def _as_utc(moment: datetime) -> datetime:
    return (moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)).astimezone(timezone.utc)


def stamp_ingestion(df: DataFrame, run_ts: datetime) -> DataFrame:
    """Processing time and its zero-padded date parts, the same for all rows of a run.

    ``run_ts`` without a zone is taken as UTC.
    """
    run_ts = _as_utc(run_ts)
    return df.withColumns(
        {
            "fecha_procesamiento_utc": F.lit(run_ts),
            "ingestion_year": F.lit(f"{run_ts:%Y}"),
            "ingestion_month": F.lit(f"{run_ts:%m}"),
            "ingestion_day": F.lit(f"{run_ts:%d}"),
        }
    )


def silver_columns(normalised: DataFrame, carry: Iterable[str] = ()) -> DataFrame:
    """Normalised rows -> silver names and order, without the stamps of a run, then the columns to ``carry`` along."""
    renamed = normalised.withColumnsRenamed(SILVER_NAMES).withColumn(
        "timestamp_iso", utc_text(F.col("timestamp_epoch"))
    )
    return renamed.select(*[c for c in SILVER.fieldNames() if c not in STAMPS], *carry)


def to_silver(normalised: DataFrame, run_ts: datetime) -> DataFrame:
    """Normalised rows -> the silver table of one run."""
    return stamp_ingestion(silver_columns(normalised), run_ts)


def preview(silver: DataFrame, rows: int = 5) -> DataFrame:
    return silver.select(*PREVIEW_COLUMNS).limit(rows)


# What tells observations of one city and second apart, and its stand-in where it is not known.
_PLACE = {"_lat": "lat", "_lon": "lon"}


def latest_observations(silver: DataFrame) -> DataFrame:
    """The rows of each observation (city, time, place) from the run that wrote it last, all of them.

    Every run reads all raw data again and appends, so silver holds an observation once per run. Only the last stamp of
    an observation is aggregated, a primitive that tasks fold before the shuffle; rows with that stamp stay by a hash join. Rows
    of one run are never copies of each other.
    """
    place = {k: F.coalesce(F.col(c).cast("double"), F.lit(float("nan"))) for k, c in _PLACE.items() if c in silver.columns}
    placed = silver.withColumns({"_city": F.coalesce("ciudad", F.lit("")), "_time": F.coalesce("timestamp_epoch", F.lit(-(2**63))), **place})
    keys = ["_city", "_time", *place]
    last = placed.groupBy(*keys).agg(F.max("fecha_procesamiento_utc").alias("_last")).toDF(*[f"{k}_of" for k in keys], "_last")
    same = [F.col(k) == F.col(f"{k}_of") for k in keys] + [F.col("fecha_procesamiento_utc").eqNullSafe(F.col("_last"))]
    return placed.join(last.hint("shuffle_hash"), same).select(*silver.columns)
