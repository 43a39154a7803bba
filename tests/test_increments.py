"""Increments of silver and gold, versions of gold, records of any shape, layout by time, compaction."""

import glob
import os
from datetime import datetime, timezone

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from catalogue import inputs
from heliovent.operators import gold, partials, silver
from heliovent.operators.normalise import normalise
from heliovent.operators.records import normalise_records
from heliovent.plans import increments
from heliovent.plans.compaction import compact, crowded_folders, packed
from heliovent.plans.increments import run_gold_increment, run_silver_increment
from heliovent.plans.jobs import run_gold
from heliovent.schemas import SILVER
from heliovent.sources import folders, readers, writers
from tests.plans import assert_no_python, physical_plan

SF_DIR = "/root/testdata/sf0.001"
RUN = datetime(2025, 1, 5, tzinfo=timezone.utc)
DAY = 1760832000  # 2025-10-19 00:00:00 UTC
FLAT = "city string, dt bigint, temp_c double"


@pytest.fixture()
def lake(spark, tmp_path):
    """Functions to drop rows into a feed, and to read what is new."""
    root = str(tmp_path)

    class Lake:
        silver, gold = f"{root}/silver", f"{root}/gold"
        n = 0

        def drop(self, rows, schema=FLAT, feed="api"):
            self.n += 1
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/raw/{feed}/{self.n}")

        def read(self, **options):
            return run_silver_increment(spark, self.silver, f"{root}/checkpoint", parquet={"api": f"{root}/raw/api"}, now=lambda: RUN, **options)

        def rows(self):
            return sorted((r.ciudad, r.timestamp_epoch, r.temperatura_c) for r in readers.read_accepted(spark, self.silver).collect())

        def again(self, number):
            folders.delete(spark, f"{root}/checkpoint/api/commits/{number}")

    return Lake()


def test_each_file_is_read_once(spark, lake):
    lake.drop([("A", 1, 1.0), (None, 2, None)])
    (first,) = lake.read()
    assert (first.lote, first.files, first.total_rows, first.clean_rows, first.rejected_rows) == ("api-00000000", 1, 2, 1, 1)
    assert first.reasons == {"sin_ciudad": 1, "sin_temperatura": 1, "sin_fecha": 0}
    assert lake.read() == []
    lake.drop([("B", 3, 3.0)])
    lake.drop([("C", 4, 4.0)])
    assert [(r.files, r.total_rows) for r in lake.read()] == [(2, 2)]
    assert lake.rows() == [("A", 1, 1.0), ("B", 3, 3.0), ("C", 4, 4.0)]


def test_a_late_copy_of_an_old_file_is_read(spark, lake, tmp_path):
    lake.drop([("A", 1, 1.0)])
    lake.read()
    lake.drop([("B", 2, 2.0)])
    for name in glob.glob(f"{tmp_path}/raw/api/2/*.parquet"):
        os.utime(name, (1_000_000_000, 1_000_000_000))
    lake.read()
    assert lake.rows() == [("A", 1, 1.0), ("B", 2, 2.0)]


def test_a_source_that_is_not_there_yet(spark, lake):
    assert lake.read() == []
    lake.drop([("A", 1, 1.0)])
    assert len(lake.read()) == 1


def test_a_batch_that_is_run_again_replaces_itself(spark, lake):
    lake.drop([("A", 1, 1.0)])
    lake.read()
    lake.drop([("B", 2, 2.0)])
    lake.read()
    lake.again(1)
    assert [r.lote for r in lake.read()] == ["api-00000001"]
    assert lake.rows() == [("A", 1, 1.0), ("B", 2, 2.0)]


def test_a_batch_that_died_in_its_write_leaves_nothing_twice(spark, lake, monkeypatch):
    lake.drop([("A", 1, 1.0)])
    real = writers.write_batch

    def dies(rows, path, lote):
        real(rows, path, lote)
        raise RuntimeError("lost")

    monkeypatch.setattr(increments, "write_batch", dies)
    with pytest.raises(PySparkException):
        lake.read()
    monkeypatch.undo()
    lake.drop([("B", 2, 2.0)])
    assert len(lake.read()) == 2
    assert lake.rows() == [("A", 1, 1.0), ("B", 2, 2.0)]


def test_batches_are_bounded_by_files(lake):
    for i in range(5):
        lake.drop([("A", i, 1.0)])
    assert [r.files for r in lake.read(files_per_batch=2)] == [2, 2, 1]
    assert len(lake.rows()) == 5


def test_files_of_a_batch_may_have_unlike_types(lake):
    lake.drop([("A", 1, 1.0)])
    lake.drop([("B", 2, 2)], "city string, dt bigint, temp_c bigint")
    lake.drop([("C", 3, "3")], "name string, dt bigint, temp_c string")
    assert [r.files for r in lake.read()] == [3]
    assert lake.rows() == [("A", 1, 1.0), ("B", 2, 2.0), ("C", 3, 3.0)]


def test_rejected_rows_keep_all_their_reasons_and_their_file(spark, lake):
    lake.drop([("A", 1, 1.0), (None, None, 5.0), ("D", 9, None)])
    lake.read()
    rejected = sorted((r.ciudad or "", r.motivos, os.path.basename(os.path.dirname(r.archivo)), r.lote) for r in readers.read_rejected(spark, lake.silver).collect())
    assert rejected == [("", ["sin_ciudad", "sin_fecha"], "1", "api-00000000"), ("D", ["sin_temperatura"], "1", "api-00000000")]
    folders_of = {os.path.basename(p) for p in glob.glob(f"{lake.silver}/lote=*/estado=*")}
    assert folders_of == {"estado=aceptado", "estado=rechazado"}


def test_accepted_and_rejected_rows_are_written_in_one_unsorted_pass(spark, lake):
    from tests.plans import last_executed_plan

    lake.drop([("A", 1, 1.0), (None, None, 5.0)])
    lake.read()
    plan = last_executed_plan(spark)
    assert plan.count("FileScan parquet") <= 1 and "Sort" not in plan


def test_json_increments_of_any_shape(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.json").write_text('[{"city_name": "A", "dt": 1, "main": {"temp": 2}}, {"city": "B", "ts": 5000, "temp_c": 3}]')
    args = (spark, str(tmp_path / "silver"), str(tmp_path / "ck"))
    assert [r.clean_rows for r in run_silver_increment(*args, json={"hist": str(raw)}, now=lambda: RUN)] == [2]
    (raw / "b.json").write_text("broken")
    assert [r.rejected_rows for r in run_silver_increment(*args, json={"hist": str(raw)}, now=lambda: RUN)] == [1]


def gold_rows(spark, root):
    return [sorted(map(tuple, t.drop("fecha_procesamiento_gold").collect()), key=repr) for t in (readers.read_daily(spark, f"{root}/daily"), readers.read_patterns(spark, f"{root}/patterns"))]


def test_gold_after_increments_is_gold_from_scratch(spark, lake):
    def rows(k):
        return [("A" if i % 3 else "B", DAY + 86_400 * (20 * k + i % 15) + 3600 * (i % 5), i / 7) for i in range(200)]

    for k in range(3):
        lake.drop(rows(k))
        lake.read()
        assert run_gold_increment(spark, lake.silver, lake.gold) == [f"api-{k:08d}"]
        accepted = readers.read_accepted(spark, lake.silver)
        want = [sorted(map(tuple, t.drop("fecha_procesamiento_gold").collect()), key=repr) for t in (gold.daily_summary(accepted), gold.hourly_patterns(accepted))]
        assert gold_rows(spark, lake.gold) == want
    assert run_gold_increment(spark, lake.silver, lake.gold) == []


def test_an_increment_reads_new_batches_and_touches_their_months_only(spark, lake):
    lake.drop([("A", DAY, 1.0)])
    lake.read()
    run_gold_increment(spark, lake.silver, lake.gold)
    (old,) = glob.glob(f"{lake.gold}/daily/mes_anio=2025-10/*.parquet")
    lake.drop([("A", DAY + 40 * 86_400, 2.0)])
    lake.read()
    plan = physical_plan(increments.new_partials(spark, lake.silver, ["api-00000001"]))
    assert "PartitionFilters: [" in plan and "lote" in plan.split("PartitionFilters: [")[1].split("]")[0]
    files = increments.new_partials(spark, lake.silver, ["api-00000001"]).inputFiles()
    scanned = readers.read_accepted(spark, lake.silver, ["api-00000001"]).select(F.input_file_name()).distinct().collect()
    assert files and len(scanned) == 1 and "lote=api-00000001" in scanned[0][0]
    run_gold_increment(spark, lake.silver, lake.gold)
    assert os.path.exists(old), "an untouched month keeps its files"
    assert glob.glob(f"{lake.gold}/daily/mes_anio=2025-11/*.parquet")


@pytest.mark.parametrize("step", ["write_months", "mark"])
def test_a_gold_increment_that_died_is_done_again(spark, lake, monkeypatch, step):
    lake.drop([("A", DAY, 1.0)])
    lake.read()
    run_gold_increment(spark, lake.silver, lake.gold)
    lake.drop([("A", DAY + 60, 4.0)])
    lake.read()
    calls = []
    where = increments if step == "write_months" else increments.folders
    real = getattr(where, step)

    def dies(*args):
        calls.append(args)
        if len(calls) == (3 if step == "write_months" else 1):
            raise RuntimeError("lost")
        return real(*args)

    monkeypatch.setattr(where, step, dies)
    with pytest.raises(RuntimeError):
        run_gold_increment(spark, lake.silver, lake.gold)
    monkeypatch.undo()
    run_gold_increment(spark, lake.silver, lake.gold)
    assert [r.promedio_temperatura_diaria_c for r in readers.read_daily(spark, f"{lake.gold}/daily").collect()] == [2.5]
    assert [r.promedio_temperatura_por_hora_mes for r in readers.read_patterns(spark, f"{lake.gold}/patterns").collect()] == [2.5]


def test_a_batch_without_an_accepted_row(spark, lake):
    lake.drop([(None, DAY, 1.0)])
    lake.read()
    assert run_gold_increment(spark, lake.silver, lake.gold) == ["api-00000000"]
    assert run_gold_increment(spark, lake.silver, lake.gold) == []


def test_partials_are_one_scan_and_one_shuffle(spark, tmp_path):
    path = str(tmp_path / "silver")
    writers.write_silver(silver.stamp_ingestion(inputs.silver_observations(spark, SF_DIR), RUN), path)
    part = partials.partial_gold(readers.read_silver(spark, path))
    text = physical_plan(part)
    assert_no_python(part)
    assert (text.count("FileScan"), text.count("Expand"), text.count("Exchange")) == (1, 1, 1)


def test_merged_partials_equal_one_pass(spark):
    rows = inputs.silver_observations(spark, SF_DIR)
    halves = [partials.partial_gold(rows.where(F.pmod("timestamp_epoch", F.lit(3)) == k)) for k in range(3)]
    merged = partials.merge_partials(halves[0].unionByName(halves[1]).unionByName(halves[2]))
    for got, want in ((partials.daily_from_partials(merged), gold.daily_summary(rows)), (partials.patterns_from_partials(merged), gold.hourly_patterns(rows))):
        assert got.dtypes == want.dtypes
        assert sorted(got.drop("fecha_procesamiento_gold").collect()) == sorted(want.drop("fecha_procesamiento_gold").collect())


# --- versions of gold ---


def write_silver_of(spark, path, rows):
    frame = spark.createDataFrame(rows, FLAT)
    writers.write_silver(silver.to_silver(normalise(frame), RUN), path)


def test_a_killed_replacement_leaves_the_old_table(spark, tmp_path):
    daily = str(tmp_path / "daily")
    table = gold.daily_summary(silver.to_silver(normalise(spark.createDataFrame([("A", DAY, 1.0), ("B", DAY, 2.0)], FLAT)), RUN))
    writers.write_daily(table, daily, versioned=True)
    broken = table.withColumn("promedio_nubes_diario", F.when(F.col("ciudad") == "B", F.raise_error(F.lit("killed")).cast("double")))
    with pytest.raises(PySparkException, match="killed"):
        writers.write_daily(broken, daily, versioned=True)
    assert {r.ciudad for r in readers.read_daily(spark, daily).collect()} == {"A", "B"}
    writers.write_daily(table.where("ciudad = 'A'"), daily, versioned=True)
    assert {r.ciudad for r in readers.read_daily(spark, daily).collect()} == {"A"}


def test_few_versions_are_kept(spark, tmp_path):
    root = str(tmp_path)
    write_silver_of(spark, f"{root}/silver", [("A", DAY, 1.0)])
    for _ in range(4):
        run_gold(spark, f"{root}/silver", f"{root}/daily", f"{root}/patterns", versioned=True)
    assert len(folders.versions(spark, f"{root}/daily")) == 2 and len(glob.glob(f"{root}/daily/v*")) == 2
    assert readers.read_patterns(spark, f"{root}/patterns").count() == 1


def test_a_plain_table_is_read_as_it_is(spark, tmp_path):
    assert folders.current(spark, str(tmp_path / "plain")) == str(tmp_path / "plain")
    assert folders.children(spark, str(tmp_path / "absent")) == []


# --- groups of unlike files ---


def test_groups_are_as_few_as_the_conflicts(spark):
    from pyspark.sql.types import StructType

    kinds = {k: StructType.fromDDL(ddl) for k, ddl in {"a": "x double, y int", "b": "x bigint", "c": "x double, z string"}.items()}
    calls = []

    def schema_of(files):
        calls.append(list(files))
        groups = readers.like_groups([], lambda f: None)
        merged = kinds[files[0][0]]
        for name in files[1:]:
            if not readers._agree(merged, kinds[name[0]]):
                return None
            merged = readers._united(merged, kinds[name[0]])
        return merged if not groups else None

    files = [f"{k}{i}" for k in "abc" for i in range(50)]
    groups = readers.like_groups(files, schema_of)
    assert [len(paths) for paths, _ in groups] == [100, 50]
    assert groups[0][1].names == ["x", "y", "z"] and sorted(f for paths, _ in groups for f in paths) == sorted(files)
    assert len(calls) < 30


def test_no_file_body_is_read_for_the_groups(spark, tmp_path):
    path = str(tmp_path / "unlike")
    for kind in ("double", "bigint"):
        spark.range(5).select(F.col("id").cast(kind).alias("v")).write.parquet(f"{path}/a {kind}")
    frames = readers.read_unlike_parquet(spark, path)
    assert sorted(f.schema["v"].dataType.simpleString() for f in frames) == ["bigint", "double"]
    assert all("binaryFile" not in physical_plan(f).lower() for f in frames)
    assert sum(f.count() for f in frames) == 10


# --- records of any shape ---


def test_records_of_any_shape_in_one_scan(spark, tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    (docs / "a.json").write_text(
        '[{"city_name": "A", "dt": 10, "main": {"temp": 1.005}, "rain": {"1h": 2.5}, "weather": [{"main": "Rain"}, {"main": "no"}], "coord": {"lat": 4}, "lon": 7},'
        ' {"city": "B", "ts": 5000, "temp_c": 1.005, "all": 40, "timezone": -18000}, {"name": "C", "dt": 7500.0, "temp_c": "warm"}]'
    )
    (docs / "b.json").write_text('{"name": "D",\n "dt": 9, "main": {}}')
    (docs / "c.json").write_text("no json")
    (docs / "d.json").write_text("[]")
    records = readers.read_json_records(spark, str(docs))
    rows = normalise_records(records, carry=["archivo"])
    assert physical_plan(rows).count("FileScan") == 1
    assert_no_python(rows)
    got = {(r.city_name, r.dt, r.temperatura_c, r.rain_1h_mm, r.clima_descripcion_corta, r.lat, r.lon, r.nubes_porcentaje, r.timezone, os.path.basename(r.archivo)) for r in rows.collect()}
    assert got == {
        ("A", 10, 1.01, 2.5, "Rain", 4.0, 7.0, None, None, "a.json"),  # nested: rounded
        ("B", 5, 1.005, None, None, None, None, 40.0, "-18000", "a.json"),
        ("C", 7, None, None, None, None, None, None, None, "a.json"),  # a fraction: milliseconds
        ("D", 9, None, None, None, None, None, None, None, "b.json"),
        (None, None, None, None, None, None, None, None, None, "c.json"),
    }


# --- layout by time, compaction ---


def test_one_day_reads_under_a_tenth_of_the_bytes(spark, tmp_path):
    """Half of the rows are one city's; days are even."""
    path = str(tmp_path / "by_time")
    days, n = 40, 200_000
    base = spark.range(n).select(
        F.when(F.col("id") % 2 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 50)).alias("ciudad"),
        (DAY + F.pmod(F.xxhash64("id"), F.lit(days * 86_400))).alias("timestamp_epoch"),
        F.rand(1).alias("temperatura_c"),
    )
    rest = {f.name: F.lit(None).cast(f.dataType) for f in SILVER if f.name not in base.columns}
    table = base.withColumns(rest).select(*SILVER.fieldNames())
    writers.write_by_time(silver.stamp_ingestion(table.drop(*silver.STAMPS), RUN), path, files=16, row_group_bytes=64 << 10)
    low, high = DAY + 20 * 86_400, DAY + 21 * 86_400 - 1
    total = read = 0
    sizes = []
    for name in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(name).metadata
        at = meta.schema.to_arrow_schema().names.index("timestamp_epoch")
        groups = [meta.row_group(i) for i in range(meta.num_row_groups)]
        sizes.append(meta.num_rows)
        total += sum(g.total_byte_size for g in groups)
        read += sum(g.total_byte_size for g in groups if g.column(at).statistics.max >= low and g.column(at).statistics.min <= high)
    assert 0 < read < total / 10
    assert max(sizes) < 2 * min(sizes), "a hot city does not make a large file"
    day = readers.read_silver(spark, path).where(F.col("timestamp_epoch").between(low, high))
    assert "PushedFilters: [IsNotNull(timestamp_epoch), GreaterThanOrEqual(timestamp_epoch" in physical_plan(day)
    assert day.count() == table.where(F.col("timestamp_epoch").between(low, high)).count()


def test_compaction(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = inputs.silver_observations(spark, SF_DIR)
    for day in (5, 6):
        writers.write_silver(silver.stamp_ingestion(rows, RUN.replace(day=day)), path, files=20)
    writers.write_silver(silver.stamp_ingestion(rows, RUN.replace(day=7)), path, files=1)
    before = sorted(map(repr, readers.read_silver(spark, path).collect()))
    untouched = glob.glob(f"{path}/*/*/ingestion_day=07/*.parquet")
    assert {r.files for r in crowded_folders(spark, path, 1 << 20).collect()} == {20}
    assert compact(spark, path) == [f"ingestion_year=2025/ingestion_month=01/ingestion_day={d}" for d in ("05", "06")]
    assert [len(glob.glob(f"{path}/*/*/ingestion_day={d}/*.parquet")) for d in ("05", "06", "07")] == [1, 1, 1]
    assert sorted(map(repr, readers.read_silver(spark, path).collect())) == before
    assert glob.glob(f"{path}/*/*/ingestion_day=07/*.parquet") == untouched
    assert compact(spark, path) == []


def test_compaction_packs_files_to_the_target_without_a_shuffle(spark, tmp_path):
    path = str(tmp_path / "silver")
    rows = silver.stamp_ingestion(inputs.silver_observations(spark, SF_DIR), RUN)
    writers.write_silver(rows, path, files=32)
    sizes = [os.path.getsize(p) for p in glob.glob(f"{path}/**/*.parquet", recursive=True)]
    target = 4 * max(sizes)
    folder = os.path.dirname(glob.glob(f"{path}/**/*.parquet", recursive=True)[0])
    frame = packed(spark, folder, SILVER, target)
    assert "Exchange" not in physical_plan(frame)
    assert 8 <= frame.rdd.getNumPartitions() <= 12
    compact(spark, path, target_bytes=target)
    assert 8 <= len(glob.glob(f"{path}/**/*.parquet", recursive=True)) <= 12
