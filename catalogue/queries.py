"""One query per operator or group of operators; every one reads the given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue import inputs
from heliovent.functions import timekeys
from heliovent.operators import gold, messages, normalise, quality, records, report, silver
from heliovent.plans import increments
from heliovent.plans.compaction import compact
from heliovent.plans.jobs import run_gold, run_medallion
from heliovent.sources import folders, readers, writers
from heliovent.streaming import raw

Query = Callable[[SparkSession, str], DataFrame]

RUN_TS = datetime(2024, 3, 7, 5, 0, tzinfo=timezone.utc)
POLL_MS = 1_760_885_100_000


def _unstamped(df: DataFrame) -> DataFrame:
    return df.drop("fecha_procesamiento_gold", "fecha_procesamiento_utc")


def _daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.daily_summary(inputs.silver_observations(spark, sf_dir))


def _patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.hourly_patterns(inputs.silver_observations(spark, sf_dir))


# --- raw to silver -----------------------------------------------------------------------


def flatten_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalise.normalise(inputs.nested_records(spark, sf_dir))


# What brings the records to 1970 and before: a unit told by the size of the values would be wrong there.
EARLIER = {"as_is": 0, "in_1970": 1_704_067_200, "in_1960": 2_019_600_000}


def flatten_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records with every spelling of the epoch: each feed has its unit, whatever the values."""
    flat = inputs.flat_records(spark, sf_dir)
    seconds = (F.col("ts") / 1000).cast("bigint")
    feeds = {
        "ms_bigint": (lambda s: {"ts": s * 1000}, None),
        "ms_double": (lambda s: {"ts": (s * 1000).cast("double")}, None),
        "s_by_name": (lambda s: {"dt": s}, None),
        "s_by_argument": (lambda s: {"ts": s}, "s"),
    }
    frames = []
    for shift, by in EARLIER.items():
        for kind, (columns, unit) in feeds.items():
            feed = flat.withColumns(columns(seconds - by))
            feed = feed.drop("ts") if kind == "s_by_name" else feed
            kinds = {"epoch_kind": F.lit(kind), "epoch_shift": F.lit(shift)}
            frames.append(normalise.normalise(feed, unit).withColumns(kinds))
    return normalise.union_sources(frames)


def precip_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.nested_records(spark, sf_dir)

    def spelled(*fields: str) -> DataFrame:
        """The records as a feed that has only these fields in ``rain``."""
        if not fields:
            return records.drop("rain")
        kept = F.struct(*[F.col("rain").getField(f).alias(f) for f in fields])
        return records.withColumn("rain", F.when(F.col("rain").isNotNull(), kept))

    feeds = {"both": spelled("1h", "_1h"), "plain": spelled("1h"), "prefixed": spelled("_1h"), "neither": spelled()}
    frames = [
        feed.select(
            "id",
            F.lit(name).alias("feed"),
            normalise.one_hour_amount(feed.schema, "rain").alias("rain_1h_mm"),
            normalise.one_hour_amount(feed.schema, "snow").alias("snow_1h_mm"),
        )
        for name, feed in feeds.items()
    ]
    return normalise.union_sources(frames)


def weather_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.nested_records(spark, sf_dir)
    names = ("clima_descripcion_corta", "clima_descripcion_larga", "clima_icono_id")
    return normalise.flatten_nested(records.withColumn("record", F.col("id"))).select("record", *names)


def coord_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.nested_records(spark, sf_dir)
    axes = [normalise.coordinate(records.schema, axis).alias(axis) for axis in ("lat", "lon")]
    return records.select("id", *axes)


def _written_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict[str, str]]:
    nested, flat = inputs.scratch(spark, "nested"), inputs.scratch(spark, "flat")
    inputs.nested_records(spark, sf_dir).write.parquet(nested)
    inputs.flat_records(spark, sf_dir).write.parquet(flat)
    missing = inputs.scratch(spark, "never_written")
    loaded, skipped = readers.load_sources(spark, parquet=[nested, missing, flat])
    if list(skipped) != [missing]:
        raise AssertionError(f"unexpected skipped sources: {skipped}")
    return loaded, skipped


def union_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _written_sources(spark, sf_dir)[0]


def _both_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    shapes = (inputs.nested_records(spark, sf_dir), inputs.flat_records(spark, sf_dir))
    return silver.to_silver(normalise.union_sources(map(normalise.normalise, shapes)), RUN_TS)


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unstamped(quality.keep_valid(_both_shapes(spark, sf_dir)))


def quality_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    nested = normalise.normalise(inputs.nested_records(spark, sf_dir))
    return quality.quality_metrics(silver.to_silver(nested, RUN_TS))


def empty_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The gate over all rows, and over those the quality rule rejects, of which none is left."""
    rows = _both_shapes(spark, sf_dir)
    outcomes = []
    for name, batch in {"all": rows, "rejected": rows.filter(~quality.is_valid())}.items():
        try:
            quality.require_rows(quality.keep_valid(batch), name)
            outcomes.append((name, False))
        except quality.EmptyTableError:
            outcomes.append((name, True))
    return spark.createDataFrame(outcomes, "batch string, is_empty boolean")


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = inputs.silver_observations(spark, sf_dir)
    return silver.preview(rows.orderBy("timestamp_epoch", "ciudad", "temperatura_c"))


def latest_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over the same records; the second one, in which all rain is known, must win."""
    first = inputs.silver_observations(spark, sf_dir)
    second = first.withColumn("lluvia_1h_mm", F.coalesce("lluvia_1h_mm", F.lit(0.0)))
    later = RUN_TS.replace(hour=17)
    runs = silver.stamp_ingestion(first, RUN_TS).unionByName(silver.stamp_ingestion(second, later))
    return silver.latest_observations(runs).drop("fecha_procesamiento_utc")


# --- sources and sinks -------------------------------------------------------------------


def scan_mixed_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A folder of unlike files: a third lack rain and snow, a third hold whole temperatures, under names in either order."""
    records = inputs.nested_records(spark, sf_dir)
    third = F.col("id") % 3
    whole = records.withColumn("main", F.col("main").withField("temp", F.col("main.temp").cast("bigint")))
    kinds = [records.where(third == 0), records.where(third == 1).drop("rain", "snow"), whole.where(third == 2)]
    frames = []
    for order, names in {"forward": "abc", "backward": "cba"}.items():
        path = inputs.scratch(spark, "unlike")
        for name, kind in zip(names, kinds):
            kind.write.parquet(f"{path}/{name}")
        loaded, _ = readers.load_sources(spark, parquet=[path], required=[path])
        frames.append(loaded.withColumn("names", F.lit(order)))
    return normalise.union_sources(frames)


def scan_parquet_recursive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files in nested day folders; the folder columns must not appear in the result."""
    path = inputs.scratch(spark, "raw_days")
    rows = inputs.silver_observations(spark, sf_dir)
    day = F.timestamp_seconds("timestamp_epoch")
    parts = {"year": F.date_format(day, "yyyy"), "month": F.date_format(day, "MM"), "day": F.date_format(day, "dd")}
    rows.withColumns(parts).hint("rebalance", *parts).write.partitionBy(*parts).parquet(path)
    return readers.read_recursive_parquet(spark, path)


def scan_json_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.scratch(spark, "documents")
    inputs.write_json_documents(inputs.nested_records(spark, sf_dir), path, "id")
    return normalise.normalise(readers.read_multiline_json(spark, path))


def silver_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = inputs.scratch(spark, "silver")
    stamped = silver.stamp_ingestion(inputs.silver_observations(spark, sf_dir), RUN_TS)
    writers.write_silver(stamped, path, files=spark.sparkContext.defaultParallelism)
    return readers.read_silver(spark, path).drop("fecha_procesamiento_utc")


def _gold_lines(daily: DataFrame, patterns: DataFrame) -> DataFrame:
    """Both gold tables in one shape."""
    null_text = F.lit(None).cast("string")
    days = daily.select(
        F.lit("daily").alias("tabla"),
        "ciudad",
        F.col("fecha_solo").cast("string").alias("periodo"),
        null_text.alias("hora"),
        F.col("promedio_potencial_eolico_diario").alias("eolico"),
        F.col("promedio_potencial_solar_diario").alias("solar"),
        F.col("promedio_temperatura_diaria_c").alias("temperatura"),
        F.col("promedio_humedad_diaria").alias("humedad"),
        F.col("total_precipitacion_diaria_mm").alias("lluvia"),
    )
    hours = patterns.select(
        F.lit("patterns").alias("tabla"),
        "ciudad",
        F.col("mes_anio").alias("periodo"),
        F.col("hora_solo").alias("hora"),
        F.col("promedio_eolico_por_hora_mes").alias("eolico"),
        F.col("promedio_solar_por_hora_mes").alias("solar"),
        F.col("promedio_temperatura_por_hora_mes").alias("temperatura"),
        F.col("promedio_humedad_por_hora_mes").alias("humedad"),
        F.lit(None).cast("double").alias("lluvia"),
    )
    return days.unionByName(hours)


def gold_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver folder -> gold job -> both gold folders read back."""
    root = inputs.scratch(spark, "medallion")
    stamped = silver.stamp_ingestion(inputs.silver_observations(spark, sf_dir), RUN_TS)
    writers.write_silver(stamped, f"{root}/silver")
    run_gold(spark, f"{root}/silver", f"{root}/daily", f"{root}/patterns")
    return _gold_lines(
        readers.read_daily(spark, f"{root}/daily"), readers.read_patterns(spark, f"{root}/patterns")
    )


def medallion_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages: nested and flat raw folders and one missing folder -> silver -> gold."""
    root = inputs.scratch(spark, "medallion")
    inputs.nested_records(spark, sf_dir).write.parquet(f"{root}/raw/nested")
    inputs.flat_records(spark, sf_dir).write.parquet(f"{root}/raw/flat")
    run_medallion(
        spark, root, root, raw_root=f"{root}/raw", parquet=["nested", "missing", "flat"], run_ts=RUN_TS
    )
    return _gold_lines(
        readers.read_daily(spark, f"{root}/gold/resumen_clima_diario"),
        readers.read_patterns(spark, f"{root}/gold/patrones_horarios"),
    )


# --- increments --------------------------------------------------------------------------

DROPS = 3


def _lake(spark: SparkSession, sf_dir: str, root: str, after_each: Callable[[], object] = lambda: None) -> None:
    """Two raw feeds in three drops, each read as it comes; then a run with nothing new, and the last batch run again."""
    nested, flat = inputs.nested_records(spark, sf_dir), inputs.flat_records(spark, sf_dir)
    drops = {"api": (nested, F.col("id")), "stream": (flat, F.floor(F.col("ts") / 1000))}

    def read() -> None:
        sources = {name: f"{root}/raw/{name}" for name in drops}
        increments.run_silver_increment(spark, f"{root}/silver", f"{root}/checkpoint", parquet=sources, now=lambda: RUN_TS)
        after_each()

    for drop in range(DROPS):
        for name, (feed, number) in drops.items():
            feed.where(F.pmod(number, F.lit(DROPS)) == drop).write.parquet(f"{root}/raw/{name}/drop_{drop}")
        read()
    read()
    folders.delete(spark, f"{root}/checkpoint/api/commits/{DROPS - 1}")  # as if the run had died before it was noted
    read()


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = inputs.scratch(spark, "increments")
    _lake(spark, sf_dir, root)
    return readers.read_accepted(spark, f"{root}/silver").drop("fecha_procesamiento_utc", "lote")


def rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected rows by feed, drop and reason; a row may have several reasons."""
    root = inputs.scratch(spark, "increments")
    _lake(spark, sf_dir, root)
    rows = readers.read_rejected(spark, f"{root}/silver")
    feed = F.split_part("lote", F.lit("-"), F.lit(1)).alias("feed")
    drop = F.regexp_extract("archivo", "/drop_([0-9]+)/", 1).cast("bigint").alias("drop")
    reasons = rows.select(feed, drop, F.explode("motivos").alias("motivo"))
    return reasons.groupBy("feed", "drop", "motivo").agg(F.count("*").alias("filas"))


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold brought up after every drop."""
    root = inputs.scratch(spark, "increments")
    _lake(spark, sf_dir, root, lambda: increments.run_gold_increment(spark, f"{root}/silver", f"{root}/gold"))
    return _gold_lines(readers.read_daily(spark, f"{root}/gold/daily"), readers.read_patterns(spark, f"{root}/gold/patterns"))


def gold_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versioned gold of half the rows, then of all; the last version is read."""
    root = inputs.scratch(spark, "versions")
    rows = silver.stamp_ingestion(inputs.silver_observations(spark, sf_dir), RUN_TS)
    early = F.col("timestamp_epoch") % 2 == 0
    for part in (early, ~early):
        writers.write_silver(rows.where(part), f"{root}/silver")
        run_gold(spark, f"{root}/silver", f"{root}/daily", f"{root}/patterns", versioned=True)
    return _gold_lines(readers.read_daily(spark, f"{root}/daily"), readers.read_patterns(spark, f"{root}/patterns"))


def json_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold nested and flat records, read once as VARIANT."""
    path = inputs.scratch(spark, "documents")
    inputs.write_mixed_documents(spark, sf_dir, path)
    return records.normalise_records(readers.read_json_records(spark, path))


def one_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fourth day of silver laid out by time."""
    path = inputs.scratch(spark, "by_time")
    rows = silver.stamp_ingestion(inputs.silver_observations(spark, sf_dir), RUN_TS)
    writers.write_by_time(rows, path, files=4 * spark.sparkContext.defaultParallelism)
    table = readers.read_silver(spark, path)
    first = table.agg(F.min("timestamp_epoch")).first()[0] // timekeys.DAY + 3
    day = table.where(F.col("timestamp_epoch").between(first * timekeys.DAY, (first + 1) * timekeys.DAY - 1))
    return day.select("ciudad", "timestamp_epoch", "temperatura_c", "humedad_porcentaje", "lluvia_1h_mm")


def compacted_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of many small files each, compacted; and how few files are left."""
    path = inputs.scratch(spark, "small")
    rows = inputs.silver_observations(spark, sf_dir)
    for remainder, moment in enumerate((RUN_TS, RUN_TS.replace(day=8))):
        part = silver.stamp_ingestion(rows.where(F.pmod("timestamp_epoch", F.lit(2)) == remainder), moment)
        writers.write_silver(part, path, files=24)
    compact(spark, path)
    table = readers.read_silver(spark, path).withColumn("file", F.col("_metadata.file_path"))
    days = table.groupBy("ingestion_day", "ciudad").agg(F.count("*").alias("filas"), F.sum("humedad_porcentaje").alias("humedad"), F.count_distinct("file").alias("files"))
    return days.select("ingestion_day", "ciudad", "filas", "humedad", (F.col("files") < 24).alias("compacted"))


# --- messages and streams ----------------------------------------------------------------


def stream_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages.parse_messages(inputs.stream_messages(spark, sf_dir))


def stream_to_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A message stream drained into day folders, read back with the day columns."""
    root = inputs.scratch(spark, "stream")
    inputs.stream_messages(spark, sf_dir).write.parquet(f"{root}/topic")
    topic = spark.readStream.schema(T.StructType([T.StructField("value", T.BinaryType())]))
    stream = raw.to_raw(topic.parquet(f"{root}/topic"))
    raw.start_raw_sink(stream, f"{root}/raw", f"{root}/checkpoint", drain=True).awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{root}/raw")


def stream_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic that grows between two drains with one checkpoint, each batch written as one file a day: every message once."""
    root = inputs.scratch(spark, "stream")
    sent = inputs.stream_messages(spark, sf_dir)
    early = F.crc32("value") % 2 == 0
    topic = spark.readStream.schema(T.StructType([T.StructField("value", T.BinaryType())]))
    for part in (early, ~early):
        sent.where(part).write.mode("append").parquet(f"{root}/topic")
        stream = raw.to_raw(topic.parquet(f"{root}/topic"))
        raw.start_raw_sink(stream, f"{root}/raw", f"{root}/checkpoint", files_per_batch=1, drain=True).awaitTermination()
    rows = spark.read.schema(stream.schema).parquet(f"{root}/raw").withColumn("file", F.input_file_name())
    files = rows.groupBy("year", "month", "day").agg(F.count_distinct("file").alias("files"), F.count(F.lit(1)).alias("messages"))
    return files.select("year", "month", "day", "messages", (F.col("files") <= 2).alias("a_file_a_batch"))


def stream_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic with messages cut off, without a readable time or a city, drained in two batches: what was kept, rejected and counted."""
    root = inputs.scratch(spark, "stream")
    records = inputs.flat_records(spark, sf_dir)
    second = F.floor(F.col("ts") / 1000)
    spoilt = records.withColumns(
        {
            "datetime_utc": F.when(second % 11 == 0, "soon").otherwise(F.col("datetime_utc")),
            "city": F.when(second % 13 != 0, F.col("city")),
        }
    )
    body = F.to_json(F.struct(*spoilt.columns), {"ignoreNullFields": "false"})
    sent = spoilt.withColumn("body", body).select(F.when(second % 7 == 0, F.left("body", F.lit(20))).otherwise(F.col("body")).cast("binary").alias("value"))
    sent.repartition(2).write.parquet(f"{root}/topic")
    topic = spark.readStream.schema(T.StructType([T.StructField("value", T.BinaryType())])).option("maxFilesPerTrigger", 1)
    judged = raw.to_judged(topic.parquet(f"{root}/topic"))
    query = raw.start_raw_sink(judged, f"{root}/raw", f"{root}/checkpoint", drain=True, partitions=raw.JUDGED_PARTITIONS)
    query.awaitTermination()
    rows = spark.read.schema(judged.schema).parquet(f"{root}/raw")
    written = rows.select("estado", F.explode_outer("motivos").alias("motivo")).groupBy("estado", "motivo").agg(F.count("*").alias("filas"))
    counted = raw.message_counts(query)
    names = F.create_map(*[F.lit(x) for item in counted.items() for x in item])
    return written.withColumn("observed", F.coalesce(names[F.col("motivo")], F.lit(counted["aceptados"])).cast("bigint"))


def payload_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    payloads = inputs.api_payloads(spark, sf_dir)
    return messages.normalise_payload(payloads, now_ms=F.lit(POLL_MS))


def publish_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of the published messages, and how many keys each has, nulls included."""
    sent = messages.as_messages(inputs.flat_records(spark, sf_dir))
    body = F.col("value").cast("string")
    fields = (
        "source STRING, city STRING, lat DOUBLE, lon DOUBLE, ts BIGINT, datetime_utc STRING, "
        "temp_c DOUBLE, humidity DOUBLE, pressure DOUBLE, wind_speed DOUBLE"
    )
    keys = F.size(F.json_object_keys(body)).cast("bigint")
    return sent.select(F.from_json(body, fields).alias("record"), keys.alias("keys")).select("record.*", "keys")


# --- gold --------------------------------------------------------------------------------


def time_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold.add_time_columns(inputs.silver_observations(spark, sf_dir))
    text = F.date_format("fecha_hora_utc", "yyyy-MM-dd HH:mm:ss").alias("fecha_hora_utc")
    return rows.select("ciudad", "timestamp_epoch", "temperatura_c", text, "fecha_solo", "hora_solo", "mes_anio")


def energy_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gold.add_energy_indices(inputs.silver_observations(spark, sf_dir))
    return rows.select(
        "ciudad",
        "timestamp_epoch",
        "velocidad_viento_m_s",
        "indice_uv",
        "nubes_porcentaje",
        "potencial_eolico_index",
        "potencial_solar_index",
    )


def daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unstamped(_daily(spark, sf_dir))


def hourly_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _unstamped(_patterns(spark, sf_dir))


def gold_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both gold tables from one aggregation."""
    rollup = gold.gold_rollup(inputs.silver_observations(spark, sf_dir))

    def either(day: Column, hour: Column) -> Column:
        return F.when(F.col("is_daily"), day).otherwise(hour)

    hours = {x: F.col(f"promedio_{x}_por_hora_mes") for x in ("eolico", "solar", "temperatura", "humedad")}
    return rollup.select(
        either(F.lit("daily"), F.lit("patterns")).alias("tabla"),
        "ciudad",
        either(F.col("fecha_solo").cast("string"), timekeys.month_text(F.col("mes"))).alias("periodo"),
        either(F.lit(None), timekeys.hour_text(F.col("hora"))).alias("hora"),
        either(F.col("promedio_potencial_eolico_diario"), hours["eolico"]).alias("eolico"),
        either(F.col("promedio_potencial_solar_diario"), hours["solar"]).alias("solar"),
        either(F.col("promedio_temperatura_diaria_c"), hours["temperatura"]).alias("temperatura"),
        either(F.col("promedio_humedad_diaria"), hours["humedad"]).alias("humedad"),
        either(F.col("total_precipitacion_diaria_mm"), F.lit(None)).alias("lluvia"),
    )


# --- report ------------------------------------------------------------------------------


def _numbered(ranked: DataFrame) -> DataFrame:
    """The place of each row in a sorted frame, a few rows to a city or hour."""
    return ranked.withColumn("place", F.monotonically_increasing_id()).withColumn("place", F.dense_rank().over(Window.orderBy("place")).cast("bigint"))


def hour_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(report.rank_hours(report.hour_profile(_patterns(spark, sf_dir))))


def city_potential(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(report.rank_cities(report.city_potential(_daily(spark, sf_dir)), "max_potencial_eolico_diario"))


def city_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _numbered(report.rank_cities(report.city_temperature(_daily(spark, sf_dir)), "max_temperatura_registro_c"))


def city_humidity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.city_humidity(_daily(spark, sf_dir))


def rain_vs_solar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.rain_vs_solar(_daily(spark, sf_dir))


def top_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top_days(_daily(spark, sf_dir))


def peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    humid = report.most_humid_city(_daily(spark, sf_dir))
    return report.peak_hours(_patterns(spark, sf_dir)).unionByName(humid)


def energy_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both gold tables from one aggregation, kept in the shared folder, then all findings from them."""
    path = inputs.scratch(spark, "rollup")
    gold.gold_rollup(inputs.silver_observations(spark, sf_dir)).write.parquet(path)
    rollup = spark.read.parquet(path)
    return report.energy_report(gold.daily_from_rollup(rollup), gold.patterns_from_rollup(rollup))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        daily_summary,
        hourly_patterns,
        gold_one_pass,
        time_columns,
        energy_indices,
        flatten_nested,
        flatten_flat,
        precip_variants,
        weather_first,
        coord_coalesce,
        union_sources,
        silver_table,
        quality_metrics,
        empty_gate,
        preview,
        latest_observations,
        scan_mixed_schema,
        scan_parquet_recursive,
        scan_json_multiline,
        silver_roundtrip,
        gold_roundtrip,
        medallion_tables,
        silver_incremental,
        rejected_rows,
        gold_incremental,
        gold_replaced,
        json_shapes,
        one_day,
        compacted_silver,
        stream_parse,
        stream_to_raw,
        stream_resumed,
        stream_rejected,
        payload_normalize,
        publish_json,
        hour_profile,
        city_potential,
        city_temperature,
        city_humidity,
        rain_vs_solar,
        top_days,
        peaks,
        energy_report,
    )
}
