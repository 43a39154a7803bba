"""Raw -> silver -> gold -> report."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import types as T

from heliovent.operators.gold import daily_from_rollup, gold_rollup, patterns_from_rollup
from heliovent.operators.quality import keep_valid, observe_quality, require_rows
from heliovent.operators.report import (
    city_potential,
    city_temperature,
    energy_report,
    hour_profile,
    rain_vs_solar,
    rank_cities,
    rank_hours,
    render_markdown,
)
from heliovent.operators.silver import latest_observations, preview, silver_columns, stamp_ingestion
from heliovent.plans.session import ensure_checkpoint_dir, require_utc
from heliovent.schemas import DAILY_PARTITIONS, PATTERN_PARTITIONS
from heliovent.sources.readers import load_sources, read_daily, read_patterns, read_silver
from heliovent.sources.writers import into_files, write_daily, write_patterns, write_silver

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class SilverRun:
    total_rows: int
    clean_rows: int
    rejected_rows: int
    skipped_sources: dict[str, str]
    preview: tuple[Row, ...] = ()


def run_silver(
    spark: SparkSession,
    silver_path: str,
    parquet: Iterable[str] = (),
    json: Iterable[str] = (),
    json_schema: T.StructType | None = None,
    run_ts: datetime | None = None,
    files: int | None = None,
    parquet_schema: T.StructType | None = None,
    required: Iterable[str] = (),
    preview_rows: int = 0,
) -> SilverRun:
    """Load all raw sources, normalise, drop invalid rows and append them to silver.

    Row counts are taken while writing. Nothing is written when no valid row exists: a first read looks for one and
    stops there, so raw data is read twice where valid rows come late, and JSON once more where its schema is inferred.
    ``preview_rows`` of the result are logged and returned.
    """
    require_utc(spark)
    combined, skipped = load_sources(spark, parquet, json, json_schema, parquet_schema, required)
    rows = silver_columns(combined)
    require_rows(keep_valid(rows), "the cleaned silver batch")

    counts = Observation("silver_quality")
    valid = observe_quality(into_files(rows, files), counts)
    # Stamped last: Spark then sees that the partition columns are constants, and writes
    # without sorting the rows by them.
    write_silver(stamp_ingestion(valid, run_ts or datetime.now(timezone.utc)), silver_path)
    shown = tuple(preview(keep_valid(rows), preview_rows).collect()) if preview_rows else ()
    for row in shown:
        log.info("silver row: %s", row)
    run = SilverRun(**counts.get, skipped_sources=skipped, preview=shown)
    if run.rejected_rows:
        log.warning("%d of %d rows rejected as incomplete", run.rejected_rows, run.total_rows)
    return run


# What gold and the choice between copies need of a silver row.
_GOLD_INPUTS = (
    "ciudad",
    "timestamp_epoch",
    "temperatura_c",
    "humedad_porcentaje",
    "velocidad_viento_m_s",
    "indice_uv",
    "nubes_porcentaje",
    "lluvia_1h_mm",
    "fecha_procesamiento_utc",
    "lat",
    "lon",
)


def run_gold(
    spark: SparkSession,
    silver_path: str,
    daily_path: str,
    patterns_path: str,
    dedupe: bool = False,
    daily_keys: Sequence[str] = DAILY_PARTITIONS,
    pattern_keys: Sequence[str] = PATTERN_PARTITIONS,
    versioned: bool = False,
) -> None:
    """Replace both gold tables from silver.

    ``versioned``: each in a new folder that becomes current once it is complete, so that a lost job leaves the table of the run before.

    Silver is scanned once for both. The aggregated result is checkpointed, so losing an
    executor between the two writes does not bring the scan back.

    Silver keeps a copy of an observation for each run that read it. ``dedupe=True`` uses the
    latest copy only; otherwise all copies count. With the
    session's SESSION_CONF Spark deletes the checkpoint once it is no longer used.
    """
    require_utc(spark)
    silver = read_silver(spark, silver_path)
    require_rows(silver, f"silver table {silver_path}")
    silver = silver.select(*_GOLD_INPUTS)
    if dedupe:
        silver = latest_observations(silver)
    ensure_checkpoint_dir(spark, f"{daily_path.rstrip('/')}_checkpoints")
    rollup = gold_rollup(silver).checkpoint()
    write_daily(daily_from_rollup(rollup), daily_path, daily_keys, versioned)
    write_patterns(patterns_from_rollup(rollup), patterns_path, pattern_keys, versioned)


def run_report(spark: SparkSession, daily_path: str, patterns_path: str) -> str:
    """Markdown report over the gold tables."""
    findings = energy_report(read_daily(spark, daily_path), read_patterns(spark, patterns_path))
    return render_markdown(findings)


def chart_tables(spark: SparkSession, daily_path: str, patterns_path: str) -> dict[str, DataFrame]:
    """The tables behind the report's charts, by name, in the order in which they are drawn."""
    daily = read_daily(spark, daily_path)
    return {
        "hour_profile": rank_hours(hour_profile(read_patterns(spark, patterns_path))),
        "city_potential": rank_cities(city_potential(daily), "max_potencial_eolico_diario"),
        "rain_vs_solar": rain_vs_solar(daily),
        "city_temperature": rank_cities(city_temperature(daily), "max_temperatura_registro_c"),
    }


def run_medallion(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    raw_root: str | None = None,
    parquet: Iterable[str] = (),
    json: Iterable[str] = (),
    run_ts: datetime | None = None,
    dedupe: bool = False,
    json_schema: T.StructType | None = None,
    parquet_schema: T.StructType | None = None,
    required: Iterable[str] = (),
    files: int | None = None,
    preview_rows: int = 0,
    daily_keys: Sequence[str] = DAILY_PARTITIONS,
    pattern_keys: Sequence[str] = PATTERN_PARTITIONS,
    versioned: bool = False,
) -> SilverRun:
    """Silver, then gold; gold is not started when silver fails.

    ``parquet``, ``json`` and ``required`` are paths below ``raw_root``, or below ``silver_root`` where no
    ``raw_root`` is given. The other arguments are those of ``run_silver`` and ``run_gold``.
    """
    base = (raw_root or silver_root).rstrip("/")
    silver_path = f"{silver_root.rstrip('/')}/silver/clima_procesado"
    gold = f"{gold_root.rstrip('/')}/gold"
    run = run_silver(
        spark,
        silver_path,
        parquet=[f"{base}/{p}" for p in parquet],
        json=[f"{base}/{p}" for p in json],
        json_schema=json_schema,
        run_ts=run_ts,
        files=files,
        parquet_schema=parquet_schema,
        required=[f"{base}/{p}" for p in required],
        preview_rows=preview_rows,
    )
    run_gold(spark, silver_path, f"{gold}/resumen_clima_diario", f"{gold}/patrones_horarios", dedupe, daily_keys, pattern_keys, versioned)
    return run
