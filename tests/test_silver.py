"""Quality rule, stamps, projection and the choice between copies."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from heliovent.operators import quality, silver
from heliovent.operators.normalise import normalise
from heliovent.schemas import SILVER

RUN = datetime(2025, 1, 5, 3, 4, 5, tzinfo=timezone.utc)


@pytest.fixture()
def rows(spark):
    df = spark.createDataFrame(
        [
            ("A", 1760841900000, 1.0),
            (None, 1760841900000, 1.0),
            ("A", None, 1.0),
            ("A", 1760841900000, None),
            (None, None, None),
        ],
        "city string, ts bigint, temp_c double",
    )
    return silver.to_silver(normalise(df), RUN)


def test_columns_and_types(rows):
    assert [(f.name, f.dataType) for f in rows.schema] == [(f.name, f.dataType) for f in SILVER]


def test_stamps(rows):
    row = rows.first()
    assert (row.ingestion_year, row.ingestion_month, row.ingestion_day) == ("2025", "01", "05")
    assert row.timestamp_iso == "2025-10-19 02:45:00"
    assert rows.select(F.unix_timestamp("fecha_procesamiento_utc")).first()[0] == int(RUN.timestamp())


def test_run_time_is_utc_whatever_its_zone(rows, spark):
    df = spark.range(1)
    bogota = timezone(timedelta(hours=-5))
    late = datetime(2025, 1, 31, 22, 0, tzinfo=bogota)
    parts = silver.stamp_ingestion(df, late).select("ingestion_month", "ingestion_day").first()
    assert tuple(parts) == ("02", "01")
    naive = silver.stamp_ingestion(df, datetime(2025, 1, 5, 3, 4, 5)).select(F.unix_timestamp("fecha_procesamiento_utc"))
    assert naive.first()[0] == int(RUN.timestamp())


def test_only_complete_rows_stay(rows):
    kept = quality.keep_valid(rows).collect()
    assert [(r.ciudad, r.timestamp_epoch, r.temperatura_c) for r in kept] == [("A", 1760841900, 1.0)]


def test_metrics(rows):
    assert tuple(quality.quality_metrics(rows).first()) == (5, 1, 4)


def test_metrics_of_nothing(rows):
    assert tuple(quality.quality_metrics(rows.filter("false")).first()) == (0, 0, 0)


def test_metrics_are_taken_while_writing(rows, tmp_path):
    counts = Observation()
    quality.observe_quality(rows, counts).write.parquet(str(tmp_path / "out"))
    assert counts.get == {"total_rows": 5, "clean_rows": 1, "rejected_rows": 4}


def test_gate(rows):
    quality.require_rows(rows, "rows")
    with pytest.raises(quality.EmptyTableError, match="nothing"):
        quality.require_rows(rows.filter("ciudad = 'Z'"), "nothing")


def test_preview(rows):
    assert silver.preview(rows, 2).count() == 2
    assert silver.preview(rows).columns == list(silver.PREVIEW_COLUMNS)


def test_latest_copy_wins(rows, spark):
    valid = quality.keep_valid(rows)
    later = valid.withColumn("lluvia_1h_mm", F.lit(9.0))
    runs = silver.stamp_ingestion(later, RUN + timedelta(hours=12)).unionByName(valid)
    latest = silver.latest_observations(runs.unionByName(valid))
    assert latest.columns == runs.columns
    assert [r.lluvia_1h_mm for r in latest.collect()] == [9.0]


def test_all_rows_of_the_last_run_stay(rows):
    valid = quality.keep_valid(rows)
    copies = [valid.withColumn("humedad_porcentaje", F.lit(float(h))) for h in (3, 9, 5)]
    twice = copies[0].union(copies[1]).union(copies[2])
    for earlier in (twice, copies[0]):
        again = silver.stamp_ingestion(twice, RUN + timedelta(hours=12))
        got = silver.latest_observations(earlier.unionByName(again))
        assert sorted(r.humedad_porcentaje for r in got.collect()) == [3.0, 5.0, 9.0]


def test_places_are_told_apart(rows):
    valid = quality.keep_valid(rows)
    here, there, nowhere = (valid.withColumn("lat", F.lit(x).cast("double")) for x in (1.0, 2.0, None))
    later = silver.stamp_ingestion(there, RUN + timedelta(hours=12))
    got = silver.latest_observations(here.union(there).union(nowhere).unionByName(later))
    assert sorted((str(r.lat), r.fecha_procesamiento_utc > valid.first().fecha_procesamiento_utc) for r in got.collect()) == [("1.0", False), ("2.0", True), ("None", False)]


def test_a_key_with_most_of_the_rows_is_folded_before_the_shuffle(spark):
    """A third of all rows are copies of one observation."""
    n = 30_000
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id"))
    df = spark.range(0, n, 1, 8).select(
        F.lit("A").alias("ciudad"),
        key.alias("timestamp_epoch"),
        F.col("id").cast("double").alias("temperatura_c"),
        F.timestamp_seconds("id").alias("fecha_procesamiento_utc"),
    )
    latest = silver.latest_observations(df)
    assert latest.count() == n - n // 3 + 1
    hot = latest.filter("timestamp_epoch = 0").first()
    assert hot.temperatura_c == max(i for i in range(0, n, 3))
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange"), "partial step below the exchange"
    assert "Sort" not in plan and "ShuffledHashJoin" in plan
