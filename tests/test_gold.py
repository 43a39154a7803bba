"""Gold aggregates: NULL rules, rounding order, one-pass equivalence, plans."""

import math
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F

from catalogue import inputs
from heliovent.operators import gold, silver
from heliovent.schemas import GOLD_DAILY, GOLD_PATTERNS, SILVER
from heliovent.sources import readers, writers
from tests.plans import assert_no_python, physical_plan

SF_DIR = "/root/testdata/sf0.001"
DAY = 1760832000  # 2025-10-19 00:00:00 UTC


def observations(spark, rows):
    """(ciudad, epoch, temp, humidity, wind, uv, clouds, rain) as silver rows."""
    names = (
        "ciudad timestamp_epoch temperatura_c humedad_porcentaje velocidad_viento_m_s indice_uv nubes_porcentaje lluvia_1h_mm"
    ).split()
    kinds = ["string", "bigint"] + ["double"] * 6
    df = spark.createDataFrame(rows, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))
    rest = {f.name: F.lit(None).cast(f.dataType) for f in SILVER if f.name not in names}
    return df.withColumns(rest).select(*SILVER.fieldNames())


@pytest.fixture()
def day(spark):
    return observations(
        spark,
        [
            ("A", DAY, 10.0, 50.0, 10.0, 8.0, 25.0, 1.255),
            ("A", DAY + 3600, 20.005, 60.0, None, None, None, None),
            ("A", DAY + 86_399, 30.0, None, 1.0, 8.0, 100.0, 1.0),
            ("A", DAY + 86_400, -5.0, 10.0, 2.0, 1.0, 0.0, 0.0),
            ("B", DAY, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0),
        ],
    )


def test_daily_summary(day):
    daily = gold.daily_summary(day)
    assert [(f.name, f.dataType) for f in daily.schema] == [(f.name, f.dataType) for f in GOLD_DAILY]
    row = daily.filter("ciudad = 'A' AND fecha_solo = '2025-10-19'").first().asDict()
    assert isinstance(row.pop("fecha_procesamiento_gold"), datetime)
    assert row == {
        "ciudad": "A",
        "fecha_solo": date(2025, 10, 19),
        "promedio_potencial_eolico_diario": 3.34,  # (10.0 + 0.0 + 0.01) / 3
        "max_potencial_eolico_diario": 10.0,
        "promedio_potencial_solar_diario": 3.67,  # (6.0 + 5.0 + 0.0) / 3
        "max_potencial_solar_diario": 6.0,
        "promedio_temperatura_diaria_c": 20.0,
        "max_temperatura_registro_c": 30.0,
        "min_temperatura_registro_c": 10.0,
        "promedio_humedad_diaria": 55.0,  # NULL does not count
        "total_precipitacion_diaria_mm": 2.26,  # NULL counts as 0
        "max_velocidad_viento_m_s": 10.0,
        "promedio_nubes_diario": 62.5,  # NULL does not count, though it is 0 in the index
    }


def test_hourly_patterns(day):
    patterns = gold.hourly_patterns(day)
    assert [(f.name, f.dataType) for f in patterns.schema] == [(f.name, f.dataType) for f in GOLD_PATTERNS]
    rows = {r.id_analisis_patron: r for r in patterns.collect()}
    assert set(rows) == {"A-2025-10-00", "A-2025-10-01", "A-2025-10-23", "B-2025-10-00"}
    first = rows["A-2025-10-00"]  # two days share the hour
    assert (first.mes_anio, first.hora_solo) == ("2025-10", "00")
    assert first.promedio_eolico_por_hora_mes == 5.04  # (10.0 + 0.08) / 2
    assert first.promedio_temperatura_por_hora_mes == 2.5
    assert first.promedio_humedad_por_hora_mes == 30.0


def test_indices_are_rounded_before_the_mean(spark):
    rows = [("A", DAY + i, 1.0, 1.0, 0.7937005259840998, 0.0, 0.0, 0.0) for i in range(3)]  # v**3 / 100 = 0.005
    assert gold.daily_summary(observations(spark, rows)).first().promedio_potencial_eolico_diario == 0.01
    rows = [("A", DAY + i, 1.0, 1.0, 0.75, 0.0, 0.0, 0.0) for i in range(3)]  # 0.0042 rounds to 0
    assert gold.daily_summary(observations(spark, rows)).first().promedio_potencial_eolico_diario == 0.0


def test_time_columns(day):
    row = gold.add_time_columns(day).filter("timestamp_epoch = %d" % (DAY + 86_399)).first()
    assert (row.fecha_solo, row.hora_solo, row.mes_anio) == (date(2025, 10, 19), "23", "2025-10")
    assert row.fecha_hora_utc.replace(tzinfo=None) is not None


def test_all_wind_and_cloud_data_missing(spark):
    df = observations(spark, [("A", DAY, 1.0, None, None, None, None, None)])
    row = gold.daily_summary(df).first()
    assert row.promedio_potencial_eolico_diario == 0.0 and row.promedio_potencial_solar_diario == 5.0
    assert row.promedio_nubes_diario is None and row.max_velocidad_viento_m_s is None
    assert row.total_precipitacion_diaria_mm == 0.0


def test_nan_measure_does_not_stop_the_job(spark):
    df = observations(spark, [("A", DAY, math.nan, 1.0, math.nan, 1.0, 1.0, 1.0)])
    assert math.isnan(gold.daily_summary(df).first().promedio_temperatura_diaria_c)


def rows_of(df):
    return sorted(map(tuple, df.drop("fecha_procesamiento_gold").collect()), key=repr)


def test_one_pass_gives_both_tables(spark):
    df = inputs.silver_observations(spark, SF_DIR)
    rollup = gold.gold_rollup(df)
    assert rows_of(gold.daily_from_rollup(rollup)) == rows_of(gold.daily_summary(df))
    assert rows_of(gold.patterns_from_rollup(rollup)) == rows_of(gold.hourly_patterns(df))


def test_unknown_keys_form_their_own_group_in_both_ways(spark):
    df = observations(spark, [(None, DAY, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0), ("A", None, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0)])
    rollup = gold.gold_rollup(df)
    assert rows_of(gold.daily_from_rollup(rollup)) == rows_of(gold.daily_summary(df))
    assert rows_of(gold.patterns_from_rollup(rollup)) == rows_of(gold.hourly_patterns(df))


def test_result_does_not_depend_on_partitioning(spark):
    df = inputs.silver_observations(spark, SF_DIR)
    assert len({repr(rows_of(gold.daily_summary(df.repartition(n)))) for n in (1, 2, 7)}) == 1


def test_a_city_with_a_third_of_all_rows(spark):
    """Its rows are folded inside the scan tasks: the shuffle sees a row per task and group."""
    n, tasks = 60_000, 6
    base = spark.range(0, n, 1, tasks)
    city = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 50).cast("string")))
    df = base.select(
        city.alias("ciudad"),
        (DAY + F.col("id") % 86_400).alias("timestamp_epoch"),
        F.lit(1.0).alias("temperatura_c"),
        F.lit(1.0).alias("humedad_porcentaje"),
        (F.col("id") % 7).cast("double").alias("velocidad_viento_m_s"),
        F.lit(2.0).alias("indice_uv"),
        F.lit(50.0).alias("nubes_porcentaje"),
        F.lit(1.0).alias("lluvia_1h_mm"),
    )
    daily = gold.daily_summary(df)
    hot = daily.filter("ciudad = 'hot'").collect()
    assert len(hot) == 1 and hot[0].total_precipitacion_diaria_mm == n / 3
    text = physical_plan(daily)
    assert text.index("partial_sum") > text.index("Exchange")
    assert "Sort" not in text


@pytest.fixture(scope="module")
def silver_path(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("silver") / "t")
    stamped = silver.stamp_ingestion(inputs.silver_observations(spark, SF_DIR), datetime(2025, 1, 5, tzinfo=timezone.utc))
    writers.write_silver(stamped, path)
    return path


def test_plans_prune_columns_and_stay_in_the_jvm(spark, silver_path):
    table = readers.read_silver(spark, silver_path)
    for df in (gold.daily_summary(table), gold.hourly_patterns(table), gold.gold_rollup(table)):
        text = physical_plan(df)
        assert_no_python(df)
        assert text.count("FileScan") == 1
        assert text.count("Exchange") == 1
        schema = df.select("ciudad")._jdf.queryExecution().executedPlan().toString()
        assert "clima_descripcion_corta" not in text and "timestamp_iso" not in text and "visibility" not in text
        assert "FileScan" in schema


def test_ingestion_filter_prunes_partitions(spark, silver_path):
    table = readers.read_silver(spark, silver_path).filter("ingestion_month = '01'")
    assert "PartitionFilters: [isnotnull(ingestion_month" in physical_plan(gold.daily_summary(table))


def test_both_tables_in_one_pass(spark):
    """The query that shapes both tables from one aggregation scans, expands and shuffles once."""
    from catalogue.queries import energy_report, gold_one_pass

    lines = gold_one_pass(spark, SF_DIR)
    lines.collect()
    text = lines._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert (text.count("FileScan"), text.count("Expand"), text.count("Exchange hashpartitioning")) == (1, 1, 1)
    findings = energy_report(spark, SF_DIR)
    assert findings._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2, "daily once, patterns once"
