"""Findings and chart tables over the gold tables.

NaN counts as missing, like NULL: neither enters a mean nor wins a ranking. Equal values are
ranked by city, then date (or by hour), ascending.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heliovent.functions.rounding import exact_mean, stable_round

FINDING_COLUMNS = ("section", "metric", "ciudad", "fecha", "hora", "value")


def _present(column: str) -> Column:
    return F.nanvl(F.col(column), F.lit(None).cast("double"))


def _means_by(df: DataFrame, key: str, *measures: str) -> DataFrame:
    known = df.filter(F.col(key).isNotNull())
    return known.groupBy(key).agg(*[exact_mean(_present(m), 10).alias(m) for m in measures])


def hour_profile(patterns: DataFrame) -> DataFrame:
    """Mean wind and solar potential by hour; every city and month weighs the same."""
    return _means_by(
        patterns, "hora_solo", "promedio_eolico_por_hora_mes", "promedio_solar_por_hora_mes"
    )


def city_humidity(daily: DataFrame) -> DataFrame:
    return _means_by(daily, "ciudad", "promedio_humedad_diaria")


def city_potential(daily: DataFrame) -> DataFrame:
    return _means_by(daily, "ciudad", "max_potencial_eolico_diario", "max_potencial_solar_diario")


def city_temperature(daily: DataFrame) -> DataFrame:
    return _means_by(daily, "ciudad", "max_temperatura_registro_c", "min_temperatura_registro_c")


def rank_hours(profile: DataFrame) -> DataFrame:
    return profile.orderBy("hora_solo")


def rank_cities(cities: DataFrame, measure: str) -> DataFrame:
    return cities.orderBy(F.col(measure).desc_nulls_last(), F.col("ciudad"))


def rain_vs_solar(daily: DataFrame) -> DataFrame:
    """One point per city and day."""
    return daily.select("ciudad", "total_precipitacion_diaria_mm", "promedio_potencial_solar_diario")


def _winner(value: str, row: list[Column], tie_break: list[str], largest: bool) -> Column:
    """Aggregate giving the row with the best value. Tasks send one candidate each: no sort."""
    v = _present(value)
    rank = F.struct(v.isNull(), -v if largest else v, *tie_break)
    return F.min_by(F.struct(*row), rank)


def _finding(section: str, metric: str, winner: str, **fields: str) -> Column:
    """One line of the report as a struct; fields not given are NULL."""
    types = {"ciudad": "string", "fecha": "date", "hora": "string", "value": "double"}
    filled = [
        (F.col(winner).getField(fields[name]) if name in fields else F.lit(None)).cast(dtype).alias(name)
        for name, dtype in types.items()
    ]
    return F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"), *filled)


def _long(one_row: DataFrame, findings: list[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*findings))).select(*FINDING_COLUMNS)


# metric -> (section, daily column, largest wins)
_TOP_DAYS = {
    "max_wind": ("extremes", "max_potencial_eolico_diario", True),
    "max_solar": ("extremes", "max_potencial_solar_diario", True),
    "min_mean_wind": ("extremes", "promedio_potencial_eolico_diario", False),
    "min_mean_solar": ("extremes", "promedio_potencial_solar_diario", False),
    "rainiest_day": ("rain_vs_solar", "total_precipitacion_diaria_mm", True),
    "hottest_day": ("conditions", "max_temperatura_registro_c", True),
    "coldest_day": ("conditions", "min_temperatura_registro_c", False),
}


def _day_winners() -> dict[str, Column]:
    solar = "promedio_potencial_solar_diario"
    winners = {}
    for metric, (_, column, largest) in _TOP_DAYS.items():
        row = [F.col("ciudad"), F.col("fecha_solo"), _present(column).alias("value"), _present(solar).alias("solar")]
        winners[metric] = _winner(column, row, ["ciudad", "fecha_solo"], largest)
    return winners


def _day_findings() -> list[Column]:
    day = {"ciudad": "ciudad", "fecha": "fecha_solo"}
    findings = [
        _finding(section, metric, metric, value="value", **day)
        for metric, (section, _, _) in _TOP_DAYS.items()
    ]
    return [*findings, _finding("rain_vs_solar", "rainiest_day_solar", "rainiest_day", value="solar", **day)]


def top_days(daily: DataFrame) -> DataFrame:
    """The record days, and the solar mean of the rainiest one, in one pass over ``daily``."""
    return _long(daily.agg(*[w.alias(metric) for metric, w in _day_winners().items()]), _day_findings())


def day_findings(daily: DataFrame) -> DataFrame:
    """``top_days`` and ``most_humid_city`` in one pass: first each city's record days and humidity, then all cities'."""
    humidity = "promedio_humedad_diaria"
    cities = daily.groupBy("ciudad").agg(
        *[w.alias(metric) for metric, w in _day_winners().items()],
        exact_mean(_present(humidity), 10).alias(humidity),
    )
    best = []
    for metric, (_, _, largest) in _TOP_DAYS.items():
        day = F.col(metric)
        value = day.getField("value")
        rank = F.struct(value.isNull(), -value if largest else value, day.getField("ciudad"), day.getField("fecha_solo"))
        best.append(F.min_by(day, rank).alias(metric))
    best.append(F.min_by(*_humid_city(humidity)).alias("most_humid_city"))
    humid = _finding("conditions", "most_humid_city", "most_humid_city", ciudad="ciudad", value="value")
    return _long(cities.agg(*best), [*_day_findings(), humid])


def _humid_city(column: str) -> tuple[Column, Column]:
    """A city's finding and its rank; a row without a city comes last."""
    value = _present(column)
    row = F.struct("ciudad", F.when(F.col("ciudad").isNotNull(), stable_round(value)).alias("value"))
    return row, F.struct(F.col("ciudad").isNull(), value.isNull(), -value, F.col("ciudad"))


def peak_hours(patterns: DataFrame) -> DataFrame:
    """Hour of day with the best mean wind potential, and the one with the best solar."""
    columns = {
        "peak_wind_hour": "promedio_eolico_por_hora_mes",
        "peak_solar_hour": "promedio_solar_por_hora_mes",
    }
    winners = [
        _winner(c, [F.col("hora_solo"), stable_round(_present(c)).alias("value")], ["hora_solo"], True).alias(m)
        for m, c in columns.items()
    ]
    findings = [_finding("hourly", m, m, hora="hora_solo", value="value") for m in columns]
    return _long(hour_profile(patterns).agg(*winners), findings)


def most_humid_city(daily: DataFrame) -> DataFrame:
    column, metric = "promedio_humedad_diaria", "most_humid_city"
    row = [F.col("ciudad"), stable_round(_present(column)).alias("value")]
    winner = _winner(column, row, ["ciudad"], True).alias(metric)
    return _long(
        city_humidity(daily).agg(winner),
        [_finding("conditions", metric, metric, ciudad="ciudad", value="value")],
    )


def energy_report(daily: DataFrame, patterns: DataFrame) -> DataFrame:
    """All findings as a long table of eleven rows."""
    return day_findings(daily).unionByName(peak_hours(patterns))


def render_markdown(findings: DataFrame) -> str:
    """Markdown text of ``energy_report`` (eleven rows, so they may go to the driver)."""
    rows = {r["metric"]: r for r in findings.collect()}

    def day(metric: str) -> str:
        return f"{rows[metric]['ciudad']}, {rows[metric]['fecha']}"

    def value(metric: str) -> str:
        return f"{rows[metric]['value']}"

    extremes = {
        "Highest wind index": "max_wind",
        "Highest solar index": "max_solar",
        "Lowest daily mean of the wind index": "min_mean_wind",
        "Lowest daily mean of the solar index": "min_mean_solar",
    }
    lines = ["# Energy potential report", "", "## Extremes", "", "| Finding | City, day | Value |", "|---|---|---|"]
    lines += [f"| {label} | {day(m)} | {value(m)} |" for label, m in extremes.items()]
    lines += ["", "## Hours of the day", ""]
    for label, m in (("wind", "peak_wind_hour"), ("solar", "peak_solar_hour")):
        lines.append(f"- Best {label} hour: {rows[m]['hora']}:00, mean index {value(m)}")
    lines += ["", "## Rain and sun", ""]
    lines.append(f"- Rainiest day: {day('rainiest_day')}, {value('rainiest_day')} mm")
    lines.append(f"- Mean solar index on that day: {value('rainiest_day_solar')}")
    lines += ["", "## Conditions", ""]
    lines.append(f"- Hottest: {day('hottest_day')}, {value('hottest_day')} °C")
    lines.append(f"- Coldest: {day('coldest_day')}, {value('coldest_day')} °C")
    humid = rows["most_humid_city"]
    lines.append(f"- Most humid city on average: {humid['ciudad']}, {humid['value']} %")
    return "\n".join(lines) + "\n"
