"""Gold from partial aggregates that add up: a batch of silver is aggregated once, and tables are merged from what is kept.

Means and totals are kept as the whole-number sums of ``exact_parts``, so any order of batches gives the result of one pass
over all of silver, digit for digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovent.functions.rounding import exact_parts, mean_of_parts, sum_of_parts
from heliovent.operators.gold import finish_daily, finish_patterns, keyed_measures

PARTS = ("high", "low", "rest", "n")

# Name of a summed measure -> its silver or index column and the decimals to which its values count.
_SUMMED = {
    "eolico": ("potencial_eolico_index", 2),
    "solar": ("potencial_solar_index", 2),
    "temperatura": ("temperatura_c", 8),
    "humedad": ("humedad_porcentaje", 8),
    "lluvia": ("lluvia_1h_mm", 8),
    "nubes": ("nubes_porcentaje", 8),
}

# Name of an extreme -> aggregate and column.
_EXTREME = {
    "max_eolico": (F.max, "potencial_eolico_index"),
    "max_solar": (F.max, "potencial_solar_index"),
    "max_temperatura": (F.max, "temperatura_c"),
    "min_temperatura": (F.min, "temperatura_c"),
    "max_viento": (F.max, "velocidad_viento_m_s"),
}

_KEYS = ("es_diario", "ciudad", "mes", "fecha_solo", "hora")


def partial_gold(silver: DataFrame, *more: str) -> DataFrame:
    """One row for each city and day, and one for each city, month and hour, apart by the columns named: one scan, one shuffle."""
    keyed = keyed_measures(silver, *more)
    common = [F.col(c) for c in (*more, "ciudad", "mes")]
    sets = [[*common, F.col("fecha_solo")], [*common, F.col("hora")]]
    sums = [
        part.alias(f"{name}_{kind}")
        for name, (column, places) in _SUMMED.items()
        for kind, part in exact_parts(F.col(column), places).items()
    ]
    extremes = [aggregate(column).alias(name) for name, (aggregate, column) in _EXTREME.items()]
    is_daily = (F.grouping("fecha_solo") == 0).alias("es_diario")
    return keyed.groupingSets(sets, *more, "ciudad", "mes", "fecha_solo", "hora").agg(is_daily, *sums, *extremes)


def merge_partials(partials: DataFrame) -> DataFrame:
    sums = [F.sum(f"{name}_{kind}").alias(f"{name}_{kind}") for name in _SUMMED for kind in PARTS]
    extremes = [aggregate(name).alias(name) for name, (aggregate, _) in _EXTREME.items()]
    return partials.groupBy(*_KEYS).agg(*sums, *extremes)


def _parts(name: str) -> dict[str, Column]:
    return {kind: F.col(f"{name}_{kind}") for kind in PARTS}


def _mean(name: str) -> Column:
    return mean_of_parts(_parts(name), places=_SUMMED[name][1])


def daily_from_partials(merged: DataFrame) -> DataFrame:
    """The daily table; unknown rain counts as none."""
    rain = F.coalesce(sum_of_parts(_parts("lluvia"), places=_SUMMED["lluvia"][1]), F.lit(0.0))
    days = merged.where("es_diario").select(
        "ciudad",
        "fecha_solo",
        _mean("eolico").alias("promedio_potencial_eolico_diario"),
        F.col("max_eolico").alias("max_potencial_eolico_diario"),
        _mean("solar").alias("promedio_potencial_solar_diario"),
        F.col("max_solar").alias("max_potencial_solar_diario"),
        _mean("temperatura").alias("promedio_temperatura_diaria_c"),
        F.col("max_temperatura").alias("max_temperatura_registro_c"),
        F.col("min_temperatura").alias("min_temperatura_registro_c"),
        _mean("humedad").alias("promedio_humedad_diaria"),
        rain.alias("total_precipitacion_diaria_mm"),
        F.col("max_viento").alias("max_velocidad_viento_m_s"),
        _mean("nubes").alias("promedio_nubes_diario"),
    )
    return finish_daily(days)


def patterns_from_partials(merged: DataFrame) -> DataFrame:
    hours = merged.where("NOT es_diario").select(
        "ciudad",
        "mes",
        "hora",
        _mean("eolico").alias("promedio_eolico_por_hora_mes"),
        _mean("solar").alias("promedio_solar_por_hora_mes"),
        _mean("temperatura").alias("promedio_temperatura_por_hora_mes"),
        _mean("humedad").alias("promedio_humedad_por_hora_mes"),
    )
    return finish_patterns(hours)
