"""Weather inputs derived from the ``events`` table, one per shape a raw feed can have.

The derivations are written twice, here and as SQL in ``oracles.py``; FIXTURES.md lists them.
"""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from heliovent.operators.silver import STAMPS
from heliovent.schemas import SILVER

RECORDS_PER_JSON_FILE = 5_000


@functools.cache
def _own_folder() -> str:
    """Of a local session without a checkpoint folder; removed when the program ends."""
    path = tempfile.mkdtemp(prefix="catalogue-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder for a table written by a query, in the cluster's shared folder."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _own_folder()
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the shared expressions k, dt, iso, city, temp, clouds, uv, wind, rain."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    kind = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("int")
    base = e.withColumns(
        {
            "k": k,
            "dt": F.unix_timestamp("ts"),
            "city": F.concat(F.lit("city_"), (F.col("user_id") % 5).cast("string")),
            "temp": F.when(kind != "error", F.col("value") / 4 - 10),
            "wind": F.col("value") / 20,
            "rain": F.when(kind == "purchase", F.col("value") / 100),
        }
    )
    return base.withColumns(
        {
            "iso": F.from_unixtime("dt", "yyyy-MM-dd HH:mm:ss"),
            "clouds": F.when(kind != "signup", F.col("k").cast("double")),
            "uv": F.when(kind != "view", (F.col("k") % 12).cast("double")),
        }
    )


def _struct(**fields: Column) -> Column:
    return F.struct(*[c.alias(name) for name, c in fields.items()])


def nested_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nested API records."""
    id_, k, kind = F.col("event_id"), F.col("k"), F.col("event_type")
    value = F.col("value")
    fifth = F.col("user_id") % 5
    known = id_ % 10 != 0

    def condition(main: Column, description: Column, icon: str) -> Column:
        return _struct(id=k.cast("bigint"), main=main, description=description, icon=F.lit(icon))

    conditions = F.array(
        condition(kind, F.concat(kind, F.lit(" sky")), "01d"),
        condition(F.lit("second"), F.lit("ignored"), "02n"),
    )
    return events(spark, sf_dir).select(
        id_.alias("id"),
        F.when(id_ % 77 != 0, F.col("dt")).alias("dt"),
        F.when(id_ % 50 != 0, F.col("city")).alias("name"),
        _struct(temp=F.col("temp"), humidity=k.cast("bigint"), pressure=950.0 + k).alias("main"),
        _struct(speed=F.col("wind"), deg=F.col("user_id") * 37 % 360).alias("wind"),
        _struct(
            lat=F.when(known, fifth.cast("double") - 40),
            lon=F.when(known, fifth.cast("double") - 70),
        ).alias("coord"),
        F.lit(-1.0).alias("lat"),
        F.lit(-2.0).alias("lon"),
        F.when(kind != "signup", _struct(all=k.cast("bigint"))).alias("clouds"),
        F.when(
            kind == "purchase",
            _struct(**{"1h": F.when(id_ % 2 == 0, value / 100), "_1h": F.when(id_ % 3 == 0, value / 50)}),
        ).alias("rain"),
        F.when(kind == "click", _struct(**{"_1h": value / 200})).alias("snow"),
        F.when(id_ % 4 == 1, F.slice(conditions, 1, 0)).when(id_ % 4 >= 2, conditions).alias("weather"),
        F.lit(-18000).cast("bigint").alias("timezone"),
        F.lit(10000).cast("bigint").alias("visibility"),
        F.lit("raw").alias("_airbyte_raw_id"),
        F.lit(200).cast("bigint").alias("cod"),
        F.lit("stations").alias("base"),
    )


def silver_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """silver-shaped rows, without run stamps."""
    k = F.col("k").cast("double")
    have = {
        "timestamp_epoch": F.col("dt"),
        "timestamp_iso": F.col("iso"),
        "temperatura_c": F.col("temp"),
        "humedad_porcentaje": k,
        "presion_hpa": 950 + k,
        "velocidad_viento_m_s": F.col("wind"),
        "indice_uv": F.col("uv"),
        "nubes_porcentaje": F.col("clouds"),
        "lluvia_1h_mm": F.col("rain"),
        "ciudad": F.col("city"),
    }
    columns = [
        have.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
        for f in SILVER
        if f.name not in STAMPS
    ]
    return events(spark, sf_dir).filter(F.col("temp").isNotNull()).select(*columns)


def flat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """flat stream records."""
    fifth = (F.col("user_id") % 5).cast("double")
    k = F.col("k").cast("double")
    return events(spark, sf_dir).select(
        F.lit("synthetic").alias("source"),
        "city",
        (fifth - 40).alias("lat"),
        (fifth - 70).alias("lon"),
        (F.col("dt") * 1000).alias("ts"),
        F.concat(F.translate("iso", " ", "T"), F.lit("Z")).alias("datetime_utc"),
        F.col("temp").alias("temp_c"),
        k.alias("humidity"),
        (950 + k).alias("pressure"),
        F.col("wind").alias("wind_speed"),
    )


def write_json_documents(records: DataFrame, path: str, key: str) -> None:
    """records as multi-line documents, one array of a bounded number of records per file."""
    chunk = F.floor(F.col(key) / RECORDS_PER_JSON_FILE)
    arrays = records.groupBy(chunk.alias("chunk")).agg(
        F.to_json(F.collect_list(F.struct(*records.columns)), {"pretty": "true"}).alias("value")
    )
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)


def write_mixed_documents(spark: SparkSession, sf_dir: str, path: str) -> None:
    """F4, nested and flat records side by side in the same arrays, fields that are NULL left out."""
    nested, flat = nested_records(spark, sf_dir), flat_records(spark, sf_dir)
    texts = nested.select(F.to_json(F.struct("*")).alias("record")).union(flat.select(F.to_json(F.struct("*"))))
    files = -(-2 * nested.count() // RECORDS_PER_JSON_FILE)
    chunks = texts.groupBy(F.pmod(F.xxhash64("record"), F.lit(files)).alias("chunk"))
    arrays = chunks.agg(F.concat(F.lit("[\n"), F.array_join(F.collect_list("record"), ",\n"), F.lit("]")).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).option("lineSep", "\n").text(path)


def stream_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """messages as a topic delivers them."""
    records = flat_records(spark, sf_dir)
    body = F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"})
    return records.select(body.cast("binary").alias("value"))


def api_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """answers of the weather API as text."""
    answer = F.struct("name", "dt", "coord", "main", "wind", "weather", "base")
    body = F.to_json(answer, {"ignoreNullFields": "false"})
    return nested_records(spark, sf_dir).select(body.alias("payload"))
