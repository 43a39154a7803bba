"""Whole stages over folders."""

import glob
import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import heliovent
from catalogue import inputs
from heliovent.operators.messages import normalise_payload
from heliovent.operators.normalise import normalise
from heliovent.operators.quality import EmptyTableError, observe_quality
from heliovent.operators.silver import silver_columns, to_silver
from heliovent.sources import readers
from heliovent.sources.readers import NoSourceError
from heliovent.streaming import raw
from tests.plans import assert_no_python, last_executed_plan, physical_plan

SF_DIR = "/root/testdata/sf0.001"
RUN = datetime(2025, 1, 5, tzinfo=timezone.utc)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    inputs.nested_records(spark, SF_DIR).write.parquet(f"{root}/raw/api")
    inputs.flat_records(spark, SF_DIR).write.parquet(f"{root}/raw/stream")
    inputs.write_json_documents(inputs.nested_records(spark, SF_DIR), f"{root}/raw/history", "id")
    return root


def run_all(spark, lake, root, **options):
    return heliovent.run_medallion(
        spark,
        root,
        root,
        raw_root=f"{lake}/raw",
        parquet=["api", "absent", "stream"],
        json=["history"],
        run_ts=options.pop("run_ts", RUN),
        **options,
    )


def test_raw_to_report(spark, lake, tmp_path):
    root = str(tmp_path)
    run = run_all(spark, lake, root)
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    assert run.total_rows == 3 * events
    assert run.clean_rows + run.rejected_rows == run.total_rows
    assert list(run.skipped_sources) == [f"{lake}/raw/absent"]
    written = readers.read_silver(spark, f"{root}/silver/clima_procesado")
    assert written.count() == run.clean_rows
    daily, patterns = f"{root}/gold/resumen_clima_diario", f"{root}/gold/patrones_horarios"
    days = written.select("ciudad", F.substring("timestamp_iso", 1, 10)).distinct().count()
    assert readers.read_daily(spark, daily).count() == days
    report = heliovent.run_report(spark, daily, patterns)
    assert report.startswith("# Energy potential report") and "None" not in report


def test_a_second_run_doubles_rain_unless_copies_are_dropped(spark, lake, tmp_path):
    def rain(root):
        daily = readers.read_daily(spark, f"{root}/gold/resumen_clima_diario")
        return daily.agg(F.sum("total_precipitacion_diaria_mm")).first()[0]

    plain, deduped = str(tmp_path / "plain"), str(tmp_path / "deduped")
    run_all(spark, lake, deduped, dedupe=True)
    once = rain(deduped)
    run_all(spark, lake, deduped, dedupe=True, run_ts=RUN.replace(hour=12))
    assert rain(deduped) == once
    run_all(spark, lake, plain)
    before = rain(plain)
    run_all(spark, lake, plain, run_ts=RUN.replace(hour=12))
    assert rain(plain) == pytest.approx(2 * before, abs=1.0)


def test_raw_root_defaults_to_the_silver_root(spark, lake, tmp_path):
    root = str(tmp_path)
    os.symlink(f"{lake}/raw/stream", f"{root}/stream")
    run = heliovent.run_medallion(spark, root, root, parquet=["stream"], run_ts=RUN)
    assert not run.skipped_sources


def test_nothing_is_written_without_a_valid_row(spark, lake, tmp_path):
    bad = str(tmp_path / "bad")
    inputs.flat_records(spark, SF_DIR).withColumn("temp_c", F.lit(None).cast("double")).write.parquet(bad)
    with pytest.raises(EmptyTableError):
        heliovent.run_silver(spark, str(tmp_path / "silver"), parquet=[bad])
    assert not os.path.exists(tmp_path / "silver")


def test_gold_does_not_start_when_silver_fails(spark, tmp_path):
    with pytest.raises(NoSourceError):
        heliovent.run_medallion(spark, str(tmp_path), str(tmp_path), parquet=["absent"])
    assert not os.path.exists(tmp_path / "gold")


def test_empty_silver_stops_gold(spark, tmp_path):
    spark.createDataFrame([], readers.SILVER).write.parquet(str(tmp_path / "silver"))
    with pytest.raises(EmptyTableError):
        heliovent.run_gold(spark, str(tmp_path / "silver"), str(tmp_path / "d"), str(tmp_path / "p"))
    assert not os.path.exists(tmp_path / "d")


def test_jobs_insist_on_utc(spark, tmp_path):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
    try:
        for job in (
            lambda: heliovent.run_silver(spark, str(tmp_path), parquet=["x"]),
            lambda: heliovent.run_gold(spark, str(tmp_path), "d", "p"),
        ):
            with pytest.raises(ValueError, match="UTC"):
                job()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_silver_counts_are_exact_with_a_shuffle_before_the_write(spark, lake, tmp_path):
    run = heliovent.run_silver(spark, str(tmp_path / "s"), parquet=[f"{lake}/raw/api"], files=3, run_ts=RUN)
    assert len(glob.glob(f"{tmp_path}/s/**/*.parquet", recursive=True)) == 3
    assert run.total_rows == spark.read.parquet(f"{lake}/raw/api").count()


def test_silver_is_one_narrow_pass(spark, lake):
    combined, _ = readers.load_sources(spark, parquet=[f"{lake}/raw/api", f"{lake}/raw/stream"])
    silver = observe_quality(to_silver(combined, RUN), Observation())
    text = physical_plan(silver)
    assert_no_python(silver)
    assert "Exchange" not in text
    assert text.count("FileScan") == 2
    assert "_airbyte_raw_id" not in text and "datetime_utc" not in text, "unused columns are not read"
    assert "struct<temp:double,humidity:bigint,pressure:double>" in text


def test_silver_is_written_without_sorting(spark, lake, tmp_path):
    heliovent.run_silver(spark, str(tmp_path / "s"), parquet=[f"{lake}/raw/api"], run_ts=RUN)
    executed = last_executed_plan(spark)
    assert "InsertIntoHadoopFsRelationCommand" in executed
    assert "Sort" not in executed and "Exchange" not in executed


def test_checkpoints_go_to_the_folder_the_cluster_names(spark, lake, tmp_path):
    shared = spark.conf.get("spark.checkpoint.dir")
    run_all(spark, lake, str(tmp_path))
    assert spark.sparkContext.getCheckpointDir().startswith((shared, f"file:{shared}"))
    assert not glob.glob(f"{tmp_path}/gold/*_checkpoints*")


def test_chart_tables(spark, lake, tmp_path):
    root = str(tmp_path)
    run_all(spark, lake, root)
    charts = heliovent.chart_tables(spark, f"{root}/gold/resumen_clima_diario", f"{root}/gold/patrones_horarios")
    assert list(charts) == ["hour_profile", "city_potential", "rain_vs_solar", "city_temperature"]
    hours = [r.hora_solo for r in charts["hour_profile"].collect()]
    assert hours == sorted(hours) and all(not t.isEmpty() for t in charts.values())


def test_medallion_passes_its_arguments_on(spark, lake, tmp_path):
    root = str(tmp_path)
    schema = inputs.nested_records(spark, SF_DIR).schema
    options = {"json_schema": schema, "files": 2, "preview_rows": 3, "required": ["api"], "daily_keys": ["fecha_solo"], "pattern_keys": ["mes_anio"]}
    run = run_all(spark, lake, root, **options)
    assert len(run.preview) == 3 and "temperatura_c" in run.preview[0]
    assert len(glob.glob(f"{root}/silver/**/*.parquet", recursive=True)) == 2
    assert glob.glob(f"{root}/gold/resumen_clima_diario/fecha_solo=*") and glob.glob(f"{root}/gold/patrones_horarios/mes_anio=*")
    assert readers.read_daily(spark, f"{root}/gold/resumen_clima_diario").count() > 0
    with pytest.raises(NoSourceError, match="absent"):
        run_all(spark, lake, root, required=["absent"])


def test_medallion_with_a_pinned_parquet_schema(spark, lake, tmp_path):
    schema = inputs.flat_records(spark, SF_DIR).drop("humidity").schema
    heliovent.run_medallion(spark, str(tmp_path), str(tmp_path), raw_root=f"{lake}/raw", parquet=["stream"], parquet_schema=schema, run_ts=RUN)
    written = readers.read_silver(spark, f"{tmp_path}/silver/clima_procesado")
    assert written.filter("humedad_porcentaje is not null").isEmpty() and not written.isEmpty()


@pytest.mark.parametrize("zone", ["America/Bogota", "Pacific/Auckland"])
def test_texts_and_keys_do_not_depend_on_the_session_zone(spark, zone):
    def texts():
        records = inputs.stream_messages(spark, SF_DIR)
        spark.conf.set("spark.sql.session.timeZone", use)
        days = raw.to_raw(records).select("datetime_utc", "year", "month", "day").collect()
        payload = spark.createDataFrame([(PAYLOAD,)], "payload string")
        observed = normalise_payload(payload).select("datetime_utc").collect()
        rows = spark.createDataFrame([(1760841900, "A", 1.0)], "dt bigint, city string, temp_c double")
        iso = silver_columns(normalise(rows)).select("timestamp_iso").collect()
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return sorted(days), observed, iso

    use = "UTC"
    want = texts()
    use = zone
    assert texts() == want
    assert want[1][0][0] == "2025-10-19T02:45:00Z" and want[2][0][0] == "2025-10-19 02:45:00"


PAYLOAD = '{"name": "A", "dt": 1760841900, "coord": {"lat": 1, "lon": 2}, "main": {"temp": 1, "humidity": 2, "pressure": 3}, "wind": {"speed": 1}}'


def test_stream_job_passes_source_options_and_insists_on_utc(spark, monkeypatch, tmp_path):
    seen = {}

    def topic(spark, servers, name, starting_offsets, **options):
        seen.update(servers=servers, name=name, offsets=starting_offsets, **options)
        return spark.readStream.format("rate").load().selectExpr("cast(cast(value as string) as binary) as value")

    monkeypatch.setattr(raw, "read_topic", topic)
    monkeypatch.setattr(raw, "start_raw_sink", lambda *a, **k: seen.update(sink=k) or type("Q", (), {"awaitTermination": lambda self: None})())
    heliovent.run_raw_stream(spark, "s:9092", "t", "p", "c", starting_offsets="earliest", source_options={"minPartitions": "8"}, interval="1 second")
    assert seen == {"servers": "s:9092", "name": "t", "offsets": "earliest", "minPartitions": "8", "sink": {"interval": "1 second"}}
    spark.conf.set("spark.sql.session.timeZone", "America/Bogota")
    try:
        with pytest.raises(ValueError, match="UTC"):
            heliovent.run_raw_stream(spark, "s:9092", "t", "p", "c")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
