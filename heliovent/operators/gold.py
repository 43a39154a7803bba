"""The gold tables: daily summary and hour-by-month patterns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovent.functions.energy import solar_index, wind_index
from heliovent.functions.rounding import exact_mean, exact_sum
from heliovent.functions.timekeys import hour_text, month_start, month_text, utc_date, utc_hour
from heliovent.schemas import GOLD_DAILY, GOLD_PATTERNS


def add_time_columns(silver: DataFrame) -> DataFrame:
    """Timestamp, date, two-digit hour and month of each observation, all UTC."""
    epoch = F.col("timestamp_epoch")
    date = utc_date(epoch)
    return silver.withColumns(
        {
            "fecha_hora_utc": F.timestamp_seconds(epoch),
            "fecha_solo": date,
            "hora_solo": hour_text(utc_hour(epoch)),
            "mes_anio": month_text(date),
        }
    )


def add_energy_indices(silver: DataFrame) -> DataFrame:
    return silver.withColumns(
        {
            "potencial_eolico_index": wind_index(F.col("velocidad_viento_m_s")),
            "potencial_solar_index": solar_index(F.col("indice_uv"), F.col("nubes_porcentaje")),
        }
    )


def keyed_measures(silver: DataFrame, *more: str) -> DataFrame:
    """Compact grouping keys, the measures and the columns named, nothing else."""
    epoch = F.col("timestamp_epoch")
    date = utc_date(epoch)
    return add_energy_indices(silver).select(
        "ciudad",
        date.alias("fecha_solo"),
        month_start(date).alias("mes"),
        utc_hour(epoch).alias("hora"),
        "potencial_eolico_index",
        "potencial_solar_index",
        "temperatura_c",
        "humedad_porcentaje",
        "lluvia_1h_mm",
        "velocidad_viento_m_s",
        "nubes_porcentaje",
        *more,
    )


# Each mean is used by both tables; in a shared pass Spark computes it once.
def _shared_means() -> dict[str, Column]:
    return {
        "eolico": exact_mean(F.col("potencial_eolico_index"), places=2),  # the indices are cents
        "solar": exact_mean(F.col("potencial_solar_index"), places=2),
        "temperatura": exact_mean(F.col("temperatura_c")),
        "humedad": exact_mean(F.col("humedad_porcentaje")),
    }


def _daily_aggregates() -> list[Column]:
    mean = _shared_means()
    rain = F.coalesce(F.col("lluvia_1h_mm"), F.lit(0.0))
    return [
        mean["eolico"].alias("promedio_potencial_eolico_diario"),
        F.max("potencial_eolico_index").alias("max_potencial_eolico_diario"),
        mean["solar"].alias("promedio_potencial_solar_diario"),
        F.max("potencial_solar_index").alias("max_potencial_solar_diario"),
        mean["temperatura"].alias("promedio_temperatura_diaria_c"),
        F.max("temperatura_c").alias("max_temperatura_registro_c"),
        F.min("temperatura_c").alias("min_temperatura_registro_c"),
        mean["humedad"].alias("promedio_humedad_diaria"),
        exact_sum(rain).alias("total_precipitacion_diaria_mm"),
        F.max("velocidad_viento_m_s").alias("max_velocidad_viento_m_s"),
        exact_mean(F.col("nubes_porcentaje")).alias("promedio_nubes_diario"),
    ]


def _pattern_aggregates() -> list[Column]:
    mean = _shared_means()
    return [
        mean["eolico"].alias("promedio_eolico_por_hora_mes"),
        mean["solar"].alias("promedio_solar_por_hora_mes"),
        mean["temperatura"].alias("promedio_temperatura_por_hora_mes"),
        mean["humedad"].alias("promedio_humedad_por_hora_mes"),
    ]


def finish_daily(grouped: DataFrame) -> DataFrame:
    """Stamp and columns of the daily table."""
    stamped = grouped.withColumn("fecha_procesamiento_gold", F.current_timestamp())
    return stamped.select(*GOLD_DAILY.fieldNames())


def finish_patterns(grouped: DataFrame) -> DataFrame:
    """Texts of the keys, id, stamp and columns of the patterns table."""
    texts = grouped.withColumns(
        {
            "mes_anio": month_text(F.col("mes")),
            "hora_solo": hour_text(F.col("hora")),
            "fecha_procesamiento_gold": F.current_timestamp(),
        }
    )
    named = texts.withColumn("id_analisis_patron", F.concat_ws("-", "ciudad", "mes_anio", "hora_solo"))
    return named.select(*GOLD_PATTERNS.fieldNames())


def daily_summary(silver: DataFrame) -> DataFrame:
    """One row per city and day."""
    return finish_daily(keyed_measures(silver).groupBy("ciudad", "fecha_solo").agg(*_daily_aggregates()))


def hourly_patterns(silver: DataFrame) -> DataFrame:
    """One row per city, month and hour of day."""
    return finish_patterns(keyed_measures(silver).groupBy("ciudad", "mes", "hora").agg(*_pattern_aggregates()))


def gold_rollup(silver: DataFrame) -> DataFrame:
    """Both gold tables in one frame, from one scan and one shuffle.

    Split it with ``daily_from_rollup`` and ``patterns_from_rollup``. It is as small as the
    two tables together, so a job can materialise it once and write both from there.
    """
    keyed = keyed_measures(silver)
    sets = [[F.col("ciudad"), F.col("fecha_solo")], [F.col("ciudad"), F.col("mes"), F.col("hora")]]
    return keyed.groupingSets(sets, "ciudad", "fecha_solo", "mes", "hora").agg(
        (F.grouping("fecha_solo") == 0).alias("is_daily"),
        *_daily_aggregates(),
        *_pattern_aggregates(),
    )


def daily_from_rollup(rollup: DataFrame) -> DataFrame:
    return finish_daily(rollup.filter("is_daily"))


def patterns_from_rollup(rollup: DataFrame) -> DataFrame:
    return finish_patterns(rollup.filter("NOT is_daily"))
