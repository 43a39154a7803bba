"""Readers and writers."""

import glob
from datetime import datetime, timezone

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from heliovent.operators import gold, quality, silver
from heliovent.operators.messages import as_messages
from heliovent.operators.normalise import normalise
from heliovent.schemas import SILVER
from heliovent.sources import readers, writers
from tests.plans import physical_plan

RUN = datetime(2025, 1, 5, tzinfo=timezone.utc)


@pytest.fixture()
def flat(spark):
    return spark.createDataFrame(
        [("A", 1760841900000, 1.0), ("A", 1760845500000, 2.0), ("B", 1760928300000, 3.0)],
        "city string, ts bigint, temp_c double",
    )


@pytest.fixture()
def table(flat):
    return silver.to_silver(normalise(flat), RUN)


def files(path):
    return glob.glob(f"{path}/**/*.parquet", recursive=True)


def test_recursive_scan_ignores_folder_columns_and_bookkeeping(spark, flat, tmp_path):
    root = str(tmp_path / "raw")
    flat.withColumns({"year": F.lit("2025"), "month": F.lit("01")}).write.partitionBy("year", "month").parquet(root)
    (tmp_path / "raw" / "_checkpoints").mkdir()
    (tmp_path / "raw" / "_checkpoints" / "metadata").write_text("{}")
    flat.write.parquet(f"{root}/deep/er/still")
    df = readers.read_recursive_parquet(spark, root)
    assert df.columns == ["city", "ts", "temp_c"]
    assert df.count() == 6


def test_partitioned_scan_reads_only_the_wanted_day(spark, flat, tmp_path):
    root = str(tmp_path / "raw")
    days = {"year": F.lit("2025"), "day": F.when(F.col("city") == "A", "19").otherwise("20")}
    flat.withColumns(days).write.partitionBy("year", "day").parquet(root)
    df = readers.read_recursive_parquet(spark, root, partitioned=True).filter("day = 20")
    assert df.count() == 1
    assert "PartitionFilters: [isnotnull(day" in physical_plan(df)


def test_multiline_json(spark, tmp_path):
    (tmp_path / "one.json").write_text('{\n "city_name": "A",\n "dt": 10,\n "main": {"temp": 1.5}\n}')
    (tmp_path / "many.json").write_text('[{"city_name": "B", "dt": 11,\n "main": {"temp": 2}}, {"city_name": "C"}]')
    rows = normalise(readers.read_multiline_json(spark, str(tmp_path))).orderBy("city_name")
    assert [(r.city_name, r.dt, r.temperatura_c) for r in rows.collect()] == [("A", 10, 1.5), ("B", 11, 2.0), ("C", None, None)]


def test_json_with_schema_needs_no_inference(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"city_name": "A", "dt": 10, "temp_c": 4}')
    schema = spark.createDataFrame([], "city_name string, dt bigint, temp_c double").schema
    assert readers.read_multiline_json(spark, str(tmp_path), schema).first() == ("A", 10, 4.0)


def test_a_column_of_some_files_is_found_whatever_their_names(spark, tmp_path):
    rain = spark.createDataFrame([("A", 1, (2.0,), (7.5,))], "name string, dt bigint, main struct<temp: double>, rain struct<`1h`: double>")
    for order in (("a", "b"), ("b", "a")):
        path = str(tmp_path / "".join(order))
        rain.write.parquet(f"{path}/{order[0]}")
        rain.drop("rain").write.parquet(f"{path}/{order[1]}")
        loaded, skipped = readers.load_sources(spark, parquet=[path])
        assert not skipped and sorted(str(r.rain_1h_mm) for r in loaded.collect()) == ["7.5", "None"]


def test_files_with_unlike_types_are_read_group_by_group(spark, tmp_path):
    path = str(tmp_path / "unlike")
    for kind in ("double", "bigint", "string"):
        df = spark.createDataFrame([("A", 1)], "name string, dt bigint").withColumn("main", F.struct(F.lit(2).cast(kind).alias("temp")))
        df.write.parquet(f"{path}/{kind}")
        df.withColumn("visibility", F.lit(3)).write.parquet(f"{path}/{kind}_and_more")
    loaded, _ = readers.load_sources(spark, parquet=[path])
    assert [(r.temperatura_c, r.dt) for r in loaded.collect()] == [(2.0, 1)] * 6
    assert sorted(str(r.visibility) for r in loaded.collect()) == ["3.0"] * 3 + ["None"] * 3


def test_pinned_schema_and_required_sources(spark, flat, tmp_path):
    good, absent = str(tmp_path / "good"), str(tmp_path / "absent")
    flat.write.parquet(good)
    schema = spark.createDataFrame([], "city string, ts bigint, temp_c double").schema
    loaded, _ = readers.load_sources(spark, parquet=[good], parquet_schema=schema, required=[good])
    assert loaded.filter("humedad_porcentaje is not null").isEmpty() and not loaded.filter("temperatura_c is not null").isEmpty()
    with pytest.raises(readers.NoSourceError, match="absent"):
        readers.load_sources(spark, parquet=[good, absent], required=[absent])


def test_other_faults_are_not_taken_for_a_missing_source(spark, monkeypatch):
    def fault(*_):
        raise PySparkException("the store did not answer")

    monkeypatch.setattr(readers, "read_recursive_parquet", fault)
    with pytest.raises(PySparkException, match="did not answer"):
        readers.load_sources(spark, parquet=["anywhere"])


def test_corrupt_json_is_one_rejected_row(spark, tmp_path):
    (tmp_path / "bad.json").write_text("not json at all")
    rows = silver.to_silver(normalise(readers.read_multiline_json(spark, str(tmp_path))), RUN)
    assert tuple(quality.quality_metrics(rows).first()) == (1, 0, 1)


def test_sources_that_cannot_be_read_are_skipped(spark, flat, tmp_path):
    good, broken, absent = (str(tmp_path / n) for n in ("good", "broken", "absent"))
    flat.write.parquet(good)
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "x.parquet").write_text("no parquet")
    (tmp_path / "old.json").write_text('[{"city_name": "J", "dt": 1, "temp_c": 1.0}]')
    loaded, skipped = readers.load_sources(
        spark, parquet=[absent, good, broken], json=[str(tmp_path / "old.json"), f"{absent}.json"]
    )
    assert set(skipped) == {absent, broken, f"{absent}.json"}
    assert all(skipped.values())
    assert sorted(r.city_name for r in loaded.collect()) == ["A", "A", "B", "J"]


def test_no_source_at_all(spark, tmp_path):
    with pytest.raises(readers.NoSourceError):
        readers.load_sources(spark, parquet=[str(tmp_path / "absent")])


def test_silver_appends_and_keeps_partition_text(spark, table, tmp_path):
    path = str(tmp_path / "silver")
    writers.write_silver(table, path, files=1)
    assert len(files(path)) == 1
    writers.write_silver(table, path)
    back = readers.read_silver(spark, path)
    assert back.count() == 6
    assert back.schema == SILVER
    assert back.select("ingestion_month", "ingestion_day").distinct().collect() == [("01", "05")]


def test_silver_files_of_different_inputs_can_be_read_together(spark, tmp_path):
    """Humidity once as a whole number and once as a fraction."""
    path = str(tmp_path / "silver")
    for kind in ("bigint", "double"):
        df = spark.createDataFrame([("A", 10, 1.0)], "city string, ts bigint, temp_c double").withColumn("humidity", F.lit(50).cast(kind))
        writers.write_silver(silver.to_silver(normalise(df), RUN), path)
    assert [r.humedad_porcentaje for r in spark.read.parquet(path).collect()] == [50.0, 50.0]


def test_silver_write_spreads_one_day_over_the_asked_files(spark, tmp_path):
    df = spark.range(1000).select(F.lit("A").alias("city"), "id", F.lit(1.0).alias("temp_c")).withColumnRenamed("id", "ts")
    path = str(tmp_path / "silver")
    writers.write_silver(silver.to_silver(normalise(df), RUN), path, files=4)
    assert len(files(path)) == 4


def test_gold_is_replaced_whole(spark, table, tmp_path):
    path = str(tmp_path / "daily")
    daily = gold.daily_summary(table)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        writers.write_daily(daily, path)
        writers.write_daily(daily.filter("ciudad = 'A'"), path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    assert {r.ciudad for r in readers.read_daily(spark, path).collect()} == {"A"}


def test_gold_layout_is_one_file_per_folder(spark, table, tmp_path):
    daily, patterns = str(tmp_path / "d"), str(tmp_path / "p")
    writers.write_daily(gold.daily_summary(table).repartition(5), daily)
    writers.write_patterns(gold.hourly_patterns(table).repartition(5), patterns)
    assert len(files(f"{daily}/ciudad=A")) == 1
    assert len(files(f"{patterns}/ciudad=A/mes_anio=2025-10")) == 1
    assert readers.read_patterns(spark, patterns).first().mes_anio == "2025-10"


def test_patterns_by_month_only(spark, table, tmp_path):
    default, by_month = str(tmp_path / "a"), str(tmp_path / "b")
    patterns = gold.hourly_patterns(table)
    writers.write_patterns(patterns, default)
    writers.write_patterns(patterns, by_month, keys=["mes_anio"])
    assert glob.glob(f"{by_month}/mes_anio=2025-10")
    a, b = (readers.read_patterns(spark, p).drop("fecha_procesamiento_gold") for p in (default, by_month))
    assert a.columns == b.columns
    assert sorted(a.collect()) == sorted(b.collect())


def test_city_filter_prunes_folders(spark, table, tmp_path):
    path = str(tmp_path / "daily")
    writers.write_daily(gold.daily_summary(table), path)
    assert "PartitionFilters: [isnotnull(ciudad" in physical_plan(readers.read_daily(spark, path).filter("ciudad = 'A'"))


def test_empty_gold_is_an_error(spark, table, tmp_path):
    gold.daily_summary(table).filter("ciudad = 'Z'").write.parquet(str(tmp_path / "daily"))
    with pytest.raises(quality.EmptyTableError):
        readers.read_daily(spark, str(tmp_path / "daily"))
    with pytest.raises(AnalysisException):
        readers.read_patterns(spark, str(tmp_path / "absent"))


def test_messages_keep_nulls_and_text(spark):
    df = spark.createDataFrame([("Río", None, 5)], "city string, lat double, ts bigint")
    assert as_messages(df).first().value.decode("utf-8") == '{"city":"Río","lat":null,"ts":5}'


def test_publish_asks_for_the_kafka_connector(spark, flat):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        writers.publish(flat, "broker:9092", "weather")
