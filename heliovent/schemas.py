"""Table schemas shared by every stage, and the column lists derived from them.

Column names and types below are fixed values: tables written by one program are
read by another, so both sides must agree on them exactly.
"""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "STRING": T.StringType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
}


def _schema(columns: str) -> T.StructType:
    """Schema from ``name TYPE, ...``; unlike ``fromDDL`` it needs no running session."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Flat observation as it travels through the message topic (ts in milliseconds).
STREAM_RECORD = _schema(
    """
    source STRING, city STRING, lat DOUBLE, lon DOUBLE, ts BIGINT, datetime_utc STRING,
    temp_c DOUBLE, humidity DOUBLE, pressure DOUBLE, wind_speed DOUBLE
    """
)

# What every source is brought to before the union (dt in seconds).
NORMALISED = _schema(
    """
    dt BIGINT, temperatura_c DOUBLE, humedad_porcentaje DOUBLE, presion_hpa DOUBLE,
    velocidad_viento_m_s DOUBLE, direccion_viento_grados DOUBLE, uv_index DOUBLE,
    snow_1h_mm DOUBLE, timezone STRING, visibility DOUBLE, nubes_porcentaje DOUBLE,
    rain_1h_mm DOUBLE, clima_descripcion_corta STRING, clima_descripcion_larga STRING,
    clima_icono_id STRING, lat DOUBLE, lon DOUBLE, city_name STRING
    """
)

SILVER = _schema(
    """
    timestamp_epoch BIGINT, timestamp_iso STRING, temperatura_c DOUBLE,
    humedad_porcentaje DOUBLE, presion_hpa DOUBLE, velocidad_viento_m_s DOUBLE,
    direccion_viento_grados DOUBLE, indice_uv DOUBLE, nieve_1h_mm DOUBLE, timezone STRING,
    visibility DOUBLE, nubes_porcentaje DOUBLE, lluvia_1h_mm DOUBLE,
    clima_descripcion_corta STRING, clima_descripcion_larga STRING, clima_icono_id STRING,
    lat DOUBLE, lon DOUBLE, ciudad STRING, fecha_procesamiento_utc TIMESTAMP,
    ingestion_year STRING, ingestion_month STRING, ingestion_day STRING
    """
)

# Silver written batch by batch: rejected rows as well, with the reasons, and where each row came from.
ACCEPTED, REJECTED = "aceptado", "rechazado"
SILVER_BATCHES = T.StructType(
    [
        *SILVER,
        T.StructField("motivos", T.ArrayType(T.StringType())),
        T.StructField("archivo", T.StringType()),
        T.StructField("estado", T.StringType()),
        T.StructField("lote", T.StringType()),
    ]
)

GOLD_DAILY = _schema(
    """
    ciudad STRING, fecha_solo DATE,
    promedio_potencial_eolico_diario DOUBLE, max_potencial_eolico_diario DOUBLE,
    promedio_potencial_solar_diario DOUBLE, max_potencial_solar_diario DOUBLE,
    promedio_temperatura_diaria_c DOUBLE, max_temperatura_registro_c DOUBLE,
    min_temperatura_registro_c DOUBLE, promedio_humedad_diaria DOUBLE,
    total_precipitacion_diaria_mm DOUBLE, max_velocidad_viento_m_s DOUBLE,
    promedio_nubes_diario DOUBLE, fecha_procesamiento_gold TIMESTAMP
    """
)

GOLD_PATTERNS = _schema(
    """
    ciudad STRING, mes_anio STRING, hora_solo STRING,
    promedio_eolico_por_hora_mes DOUBLE, promedio_solar_por_hora_mes DOUBLE,
    promedio_temperatura_por_hora_mes DOUBLE, promedio_humedad_por_hora_mes DOUBLE,
    id_analisis_patron STRING, fecha_procesamiento_gold TIMESTAMP
    """
)

RAW_PARTITIONS = ("year", "month", "day")
SILVER_PARTITIONS = ("ingestion_year", "ingestion_month", "ingestion_day")
DAILY_PARTITIONS = ("ciudad",)
PATTERN_PARTITIONS = ("ciudad", "mes_anio")
