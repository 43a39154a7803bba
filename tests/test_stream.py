"""Messages, payloads and the streaming sink."""

import glob
import json
import time

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue import inputs
from heliovent.operators.messages import add_day_partitions, judge_messages, normalise_payload, parse_messages
from heliovent.operators.normalise import normalise
from heliovent.schemas import STREAM_RECORD
from heliovent.sources.readers import read_recursive_parquet
from heliovent.streaming import raw

VALUE = T.StructType([T.StructField("value", T.BinaryType())])
SF_DIR = "/root/testdata/sf0.001"


def messages(spark, *bodies):
    return spark.createDataFrame([(b.encode(),) for b in bodies], VALUE)


def record(city="A", when="2025-10-19T02:45:00Z", **more):
    return json.dumps({"city": city, "datetime_utc": when, "ts": 1760841900000, "temp_c": 1.5, **more})


def test_parse(spark):
    got = parse_messages(messages(spark, record(source="s", humidity=50)))
    assert got.schema == STREAM_RECORD
    row = got.first()
    assert (row.source, row.city, row.ts, row.humidity, row.lat) == ("s", "A", 1760841900000, 50.0, None)


@pytest.mark.parametrize("body", ["{bad", "null", "", "[]", "{}"])
def test_malformed_message_is_a_row_of_nulls(spark, body):
    assert set(raw.to_raw(messages(spark, body)).first()) == {None}


def test_field_of_wrong_type_is_null_alone(spark):
    row = parse_messages(messages(spark, '{"city": "A", "temp_c": "hot", "ts": 5}')).first()
    assert (row.city, row.temp_c, row.ts) == ("A", None, 5)


@pytest.mark.parametrize(
    "when, parts",
    [
        ("2025-10-19T02:45:00Z", ("2025", "10", "19")),
        ("2025-01-05T23:59:59Z", ("2025", "01", "05")),
        ("2025-01-05T23:59:59-05:00", ("2025", "01", "06")),
        ("once", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_day_partitions(spark, when, parts):
    df = spark.createDataFrame([(when,)], "datetime_utc string")
    got = add_day_partitions(df)
    assert got.columns == ["datetime_utc", "year", "month", "day"]
    assert tuple(got.first())[1:] == parts


PAYLOAD = {
    "name": "Patagonia",
    "dt": 1760841900,
    "coord": {"lat": -41, "lon": -70.5},
    "main": {"temp": 8.12, "humidity": 60, "pressure": 1001, "temp_min": 7},
    "wind": {"speed": 3.6, "deg": 10},
    "weather": [{"main": "Clear"}],
}


def payloads(spark, *answers):
    return spark.createDataFrame([(a if isinstance(a, str) else json.dumps(a),) for a in answers], "payload string")


def test_payload_to_record(spark):
    got = normalise_payload(payloads(spark, PAYLOAD), now_ms=F.lit(1760841999123))
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in STREAM_RECORD]
    assert tuple(got.first()) == (
        "openweather", "Patagonia", -41.0, -70.5, 1760841999123, "2025-10-19T02:45:00Z", 8.12, 60.0, 1001.0, 3.6
    )


def test_payload_time_of_polling_is_now(spark):
    before = int(time.time() * 1000)
    ts = normalise_payload(payloads(spark, PAYLOAD)).first().ts
    assert before - 1000 <= ts <= int(time.time() * 1000) + 1000


def test_incomplete_payloads_give_no_record(spark):
    without = [
        {k: v for k, v in PAYLOAD.items() if k != part} for part in ("dt", "coord", "main", "wind")
    ]
    no_temp = {**PAYLOAD, "main": {"humidity": 1, "pressure": 2}}
    null_dt = {**PAYLOAD, "dt": None}
    df = payloads(spark, "{bad", '{"cod": 404}', no_temp, null_dt, *without)
    assert normalise_payload(df).count() == 0


def test_null_values_are_not_missing_keys(spark):
    answer = {**PAYLOAD, "name": None, "main": {**PAYLOAD["main"], "temp": None}}
    row = normalise_payload(payloads(spark, answer)).first()
    assert (row.city, row.temp_c, row.humidity) == (None, None, 60.0)


def topic(spark, path):
    return spark.readStream.schema(VALUE).parquet(path)


def drain(spark, root, **options):
    stream = raw.to_raw(topic(spark, f"{root}/topic"))
    raw.start_raw_sink(stream, f"{root}/raw", f"{root}/checkpoint", drain=True, **options).awaitTermination()


def test_stream_equals_batch(spark, tmp_path):
    root = str(tmp_path)
    inputs.stream_messages(spark, SF_DIR).repartition(3).write.parquet(f"{root}/topic")
    drain(spark, root)
    batch = raw.to_raw(spark.read.parquet(f"{root}/topic"))
    streamed = spark.read.schema(batch.schema).parquet(f"{root}/raw").select(*batch.columns)
    assert sorted(map(repr, streamed.collect())) == sorted(map(repr, batch.collect()))


def test_stream_resumes_without_repeating(spark, tmp_path):
    root = str(tmp_path)
    messages(spark, record("A")).write.parquet(f"{root}/topic")
    drain(spark, root)
    drain(spark, root)
    messages(spark, record("B"), record("late", "2024-02-29T00:00:00Z")).write.mode("append").parquet(f"{root}/topic")
    drain(spark, root)
    rows = spark.read.parquet(f"{root}/raw").collect()
    assert sorted(r.city for r in rows) == ["A", "B", "late"]
    assert glob.glob(f"{root}/raw/year=2024/month=02/day=29/*.parquet"), "late record lands in its own day"


def test_malformed_messages_land_in_the_default_partition(spark, tmp_path):
    root = str(tmp_path)
    messages(spark, "{bad", record()).write.parquet(f"{root}/topic")
    drain(spark, root)
    assert glob.glob(f"{root}/raw/year=__HIVE_DEFAULT_PARTITION__/*/*/*.parquet")


def test_one_file_per_batch_and_day(spark, tmp_path):
    root = str(tmp_path)
    messages(spark, *[record(str(i)) for i in range(20)]).repartition(4).write.parquet(f"{root}/topic")
    drain(spark, root, files_per_batch=1)
    assert len(glob.glob(f"{root}/raw/year=2025/month=10/day=19/*.parquet")) == 1


@pytest.mark.parametrize("options", [{"files_per_batch": 1}, {}])
def test_days_of_a_batch_go_to_several_tasks(spark, tmp_path, options):
    root, coalesce = str(tmp_path), "spark.sql.adaptive.coalescePartitions.enabled"
    days = [f"2025-10-{day:02}T02:45:00Z" for day in range(1, 17)]
    messages(spark, *[record(when=when) for when in 3 * days]).coalesce(1).write.parquet(f"{root}/topic")
    spark.conf.set(coalesce, "false")
    try:
        drain(spark, root, **options)
    finally:
        spark.conf.unset(coalesce)
    files = glob.glob(f"{root}/raw/year=2025/month=10/*/*.parquet")
    assert len(files) == len(days)
    assert len({file.split("/part-")[1][:5] for file in files}) > 1
    assert spark.read.parquet(f"{root}/raw").count() == 3 * len(days)


@pytest.mark.parametrize("most", [1, 3])
def test_files_of_a_batch_and_day_are_bounded(spark, tmp_path, most):
    root = str(tmp_path)
    messages(spark, *[record(str(i)) for i in range(200)]).repartition(4).write.parquet(f"{root}/topic")
    drain(spark, root, files_per_batch=most)
    assert 1 <= len(glob.glob(f"{root}/raw/year=2025/month=10/day=19/*.parquet")) <= most
    assert spark.read.parquet(f"{root}/raw").count() == 200


def test_raw_folder_can_be_read_as_a_source(spark, tmp_path):
    root = str(tmp_path)
    messages(spark, record("A", humidity=1)).write.parquet(f"{root}/topic")
    drain(spark, root)
    source = read_recursive_parquet(spark, f"{root}/raw")
    assert source.columns == STREAM_RECORD.fieldNames()
    row = normalise(source).first()
    assert (row.city_name, row.dt, row.temperatura_c) == ("A", 1760841900, 1.5)


def test_interval_trigger(spark, tmp_path):
    root = str(tmp_path)
    messages(spark, record()).write.parquet(f"{root}/topic")
    query = raw.start_raw_sink(raw.to_raw(topic(spark, f"{root}/topic")), f"{root}/raw", f"{root}/checkpoint")
    try:
        # The first batch runs at once, the next a day later.
        deadline = time.time() + 60
        while query.lastProgress is None and time.time() < deadline:
            time.sleep(0.2)
        assert query.isActive
        assert query.lastProgress["numInputRows"] == 1
    finally:
        query.stop()
    assert spark.read.parquet(f"{root}/raw").count() == 1


def test_topic_needs_the_kafka_connector(spark):
    with pytest.raises(AnalysisException, match="(?i)kafka"):
        raw.read_topic(spark, "broker:9092", "weather", minPartitions="64")


@pytest.mark.parametrize(
    ("body", "reasons"),
    [
        ("{bad", ["sin_json", "sin_fecha", "sin_ciudad"]),
        ("", ["sin_json", "sin_fecha", "sin_ciudad"]),
        ("{}", ["sin_fecha", "sin_ciudad"]),
        ("null", ["sin_fecha", "sin_ciudad"]),
        (record(when="soon"), ["sin_fecha"]),
        (record(city=None), ["sin_ciudad"]),
        (record(temp_c="hot"), []),
        (record(), []),
    ],
)
def test_messages_are_judged_and_rejected_ones_kept(spark, body, reasons):
    row = judge_messages(messages(spark, body)).first()
    assert row.motivos == reasons
    assert (row.estado, row.mensaje) == (("rechazado", body) if reasons else ("aceptado", None))


def test_a_stream_counts_its_rejected_messages(spark, tmp_path):
    root = str(tmp_path)
    messages(spark, record(), record(), "{bad", record(when="soon")).coalesce(1).write.parquet(f"{root}/topic")
    stream = raw.to_judged(spark.readStream.schema(VALUE).parquet(f"{root}/topic"))
    query = raw.start_raw_sink(stream, f"{root}/raw", f"{root}/ck", drain=True, partitions=raw.JUDGED_PARTITIONS)
    query.awaitTermination()
    assert raw.message_counts(query) == {"total": 4, "aceptados": 2, "sin_json": 1, "sin_fecha": 2, "sin_ciudad": 1}
    rows = spark.read.schema(stream.schema).parquet(f"{root}/raw")
    assert sorted(r.mensaje for r in rows.where("estado = 'rechazado'").collect()) == sorted(["{bad", record(when="soon")])
    assert {p.split("/")[-1] for p in glob.glob(f"{root}/raw/estado=*")} == {"estado=aceptado", "estado=rechazado"}
