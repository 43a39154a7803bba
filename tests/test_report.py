"""Findings against a pandas computation of the same, ties, missing values, text."""

import math
from datetime import date

import pandas as pd
import pytest

from catalogue import inputs
from heliovent.operators import gold, report
from heliovent.schemas import GOLD_DAILY, GOLD_PATTERNS
from tests.plans import assert_no_python

SF_DIR = "/root/testdata/sf0.01"


def table(spark, schema, rows):
    """Gold rows from dicts; absent columns are NULL."""
    return spark.createDataFrame([tuple(r.get(c) for c in schema.fieldNames()) for r in rows], schema)


@pytest.fixture(scope="module")
def gold_tables(spark):
    rows = inputs.silver_observations(spark, SF_DIR)
    return gold.daily_summary(rows).persist(), gold.hourly_patterns(rows).persist()


@pytest.fixture(scope="module")
def frames(gold_tables):
    """The same tables in pandas, in the order that decides ties."""
    daily, patterns = (pd.DataFrame([r.asDict() for r in t.collect()]) for t in gold_tables)
    return daily.sort_values(["ciudad", "fecha_solo"]).reset_index(drop=True), patterns


def test_findings_agree_with_pandas(gold_tables, frames):
    daily, patterns = frames
    found = {r["metric"]: r for r in report.energy_report(*gold_tables).collect()}
    assert len(found) == 11

    for metric, column, pick in (
        ("max_wind", "max_potencial_eolico_diario", "idxmax"),
        ("max_solar", "max_potencial_solar_diario", "idxmax"),
        ("min_mean_wind", "promedio_potencial_eolico_diario", "idxmin"),
        ("min_mean_solar", "promedio_potencial_solar_diario", "idxmin"),
        ("rainiest_day", "total_precipitacion_diaria_mm", "idxmax"),
        ("hottest_day", "max_temperatura_registro_c", "idxmax"),
        ("coldest_day", "min_temperatura_registro_c", "idxmin"),
    ):
        row = daily.loc[getattr(daily[column], pick)()]
        got = found[metric]
        assert (got["ciudad"], got["fecha"], got["value"]) == (row["ciudad"], row["fecha_solo"], row[column])
    rainy = daily.loc[daily["total_precipitacion_diaria_mm"].idxmax()]
    assert found["rainiest_day_solar"]["value"] == rainy["promedio_potencial_solar_diario"]

    for metric, column in (
        ("peak_wind_hour", "promedio_eolico_por_hora_mes"),
        ("peak_solar_hour", "promedio_solar_por_hora_mes"),
    ):
        means = patterns.groupby("hora_solo")[column].mean()
        assert found[metric]["hora"] == means.idxmax()
        assert found[metric]["value"] == pytest.approx(means.max(), abs=0.005 + 1e-9)
    humid = daily.groupby("ciudad")["promedio_humedad_diaria"].mean()
    assert found["most_humid_city"]["ciudad"] == humid.idxmax()


def test_chart_tables_agree_with_pandas(gold_tables, frames):
    daily, patterns = frames
    spark_daily, spark_patterns = gold_tables
    for got, frame, key in (
        (report.city_potential(spark_daily), daily, "ciudad"),
        (report.city_temperature(spark_daily), daily, "ciudad"),
        (report.city_humidity(spark_daily), daily, "ciudad"),
        (report.hour_profile(spark_patterns), patterns, "hora_solo"),
    ):
        measures = got.columns[1:]
        want = frame.groupby(key)[measures].mean()
        for row in got.collect():
            assert list(row[1:]) == pytest.approx(list(want.loc[row[0]]), abs=1e-9)


def test_sorted_tables(gold_tables):
    daily, patterns = gold_tables
    hours = [r.hora_solo for r in report.rank_hours(report.hour_profile(patterns)).collect()]
    assert hours == sorted(hours) and len(hours) == 24
    for cities, column in (
        (report.city_potential(daily), "max_potencial_eolico_diario"),
        (report.city_temperature(daily), "max_temperatura_registro_c"),
    ):
        values = [r[column] for r in report.rank_cities(cities, column).collect()]
        assert values == sorted(values, reverse=True)


def test_ties_go_to_the_first_city_and_day(spark):
    same = {"max_potencial_eolico_diario": 5.0, "promedio_potencial_eolico_diario": 1.0}
    rows = [
        {"ciudad": "B", "fecha_solo": date(2025, 1, 1), **same},
        {"ciudad": "A", "fecha_solo": date(2025, 1, 3), **same},
        {"ciudad": "A", "fecha_solo": date(2025, 1, 2), **same},
    ]
    found = {r.metric: r for r in report.top_days(table(spark, GOLD_DAILY, rows).repartition(3)).collect()}
    for metric in ("max_wind", "min_mean_wind"):
        assert (found[metric].ciudad, found[metric].fecha) == ("A", date(2025, 1, 2))


def test_tied_hours_go_to_the_earliest(spark):
    rows = [
        {"ciudad": c, "mes_anio": "2025-01", "hora_solo": h, "promedio_eolico_por_hora_mes": 2.0, "promedio_solar_por_hora_mes": s}
        for c, h, s in (("A", "07", 1.0), ("A", "03", 1.0), ("B", "05", 4.0))
    ]
    found = {r.metric: r for r in report.peak_hours(table(spark, GOLD_PATTERNS, rows)).collect()}
    assert found["peak_wind_hour"].hora == "03"
    assert (found["peak_solar_hour"].hora, found["peak_solar_hour"].value) == ("05", 4.0)


def test_missing_values_neither_win_nor_count(spark):
    rows = [
        {"ciudad": "A", "fecha_solo": date(2025, 1, 1), "max_potencial_eolico_diario": v, "promedio_humedad_diaria": h}
        for v, h in ((None, None), (math.nan, math.nan), (3.0, 10.0), (1.0, 20.0))
    ]
    daily = table(spark, GOLD_DAILY, rows)
    found = {r.metric: r for r in report.top_days(daily).collect()}
    assert found["max_wind"].value == 3.0
    assert report.city_humidity(daily).first().promedio_humedad_diaria == 15.0
    assert found["hottest_day"].value is None


def test_cities_without_name_are_left_out_of_the_means(spark):
    rows = [{"ciudad": c, "fecha_solo": date(2025, 1, 1), "promedio_humedad_diaria": 5.0} for c in (None, "A")]
    assert [r.ciudad for r in report.city_humidity(table(spark, GOLD_DAILY, rows)).collect()] == ["A"]


def test_scatter_points(gold_tables):
    daily = gold_tables[0]
    assert report.rain_vs_solar(daily).count() == daily.count()


def test_markdown(gold_tables):
    text = report.render_markdown(report.energy_report(*gold_tables))
    for part in ("# Energy potential report", "## Extremes", "## Hours of the day", "## Rain and sun", "## Conditions"):
        assert part in text
    assert "None" not in text and "nan" not in text


def test_no_python_in_the_plan(spark):
    rows = inputs.silver_observations(spark, SF_DIR)
    assert_no_python(report.energy_report(gold.daily_summary(rows), gold.hourly_patterns(rows)))
