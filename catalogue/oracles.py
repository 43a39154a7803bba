"""DuckDB SQL giving the expected rows of each query, written independently of the library.

Rounding in the SQL:
  per record  half up on the decimal text of the double (what Spark's ``round`` does)
  aggregates  sums of whole 10^-8 units (10^-2 for the indices), divided once, half up
"""

from __future__ import annotations


def _per_record(x: str) -> str:
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


def _stable(x: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _mean(x: str, digits: int = 2, places: int = 8) -> str:
    """Whole units of 10^-places, summed; the quotient half up to ``digits``."""
    total, n = f"sum(CAST(round({x} * 1e{places}) AS HUGEINT))", f"CAST(count({x}) AS HUGEINT)"
    up, down = 10 ** max(0, digits - places), 10 ** max(0, places - digits)
    return f"CAST(sign({total}) * ((2 * abs({total}) * {up} + {n} * {down}) // nullif(2 * {n} * {down}, 0)) AS DOUBLE) / 1e{digits}"


def _sum(x: str) -> str:
    total = f"sum(CAST(round({x} * 1e8) AS HUGEINT))"
    return f"CAST(sign({total}) * ((2 * abs({total}) + 1000000) // 2000000) AS DOUBLE) / 100"


_EVENTS = """
e AS (
  SELECT event_id, user_id, event_type, value,
    CAST(json_extract_string(props, '$.k') AS INT) AS k,
    CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS dt,
    strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS iso,
    'city_' || (user_id % 5) AS city,
    CASE WHEN event_type = 'error' THEN NULL ELSE value / 4 - 10 END AS temp,
    value / 20 AS wind,
    CASE WHEN event_type = 'purchase' THEN value / 100 END AS rain
  FROM events
)
"""

_NESTED = f"""
nested AS (
  SELECT event_id AS id,
    CASE WHEN event_id % 77 <> 0 THEN dt END AS dt,
    {_per_record("temp")} AS temperatura_c,
    CAST(k AS DOUBLE) AS humedad_porcentaje,
    950.0::DOUBLE + k AS presion_hpa,
    {_per_record("wind")} AS velocidad_viento_m_s,
    CAST(user_id * 37 % 360 AS DOUBLE) AS direccion_viento_grados,
    CAST(NULL AS DOUBLE) AS uv_index,
    CASE WHEN event_type = 'click' THEN value / 200 END AS snow_1h_mm,
    '-18000' AS timezone,
    10000.0::DOUBLE AS visibility,
    CASE WHEN event_type <> 'signup' THEN CAST(k AS DOUBLE) END AS nubes_porcentaje,
    CASE WHEN event_type = 'purchase' THEN
      CASE WHEN event_id % 2 = 0 THEN value / 100 WHEN event_id % 3 = 0 THEN value / 50 END
    END AS rain_1h_mm,
    CASE WHEN event_id % 4 >= 2 THEN event_type END AS clima_descripcion_corta,
    CASE WHEN event_id % 4 >= 2 THEN event_type || ' sky' END AS clima_descripcion_larga,
    CASE WHEN event_id % 4 >= 2 THEN '01d' END AS clima_icono_id,
    CASE WHEN event_id % 10 <> 0 THEN CAST(user_id % 5 - 40 AS DOUBLE) ELSE -1.0::DOUBLE END AS lat,
    CASE WHEN event_id % 10 <> 0 THEN CAST(user_id % 5 - 70 AS DOUBLE) ELSE -2.0::DOUBLE END AS lon,
    CASE WHEN event_id % 50 <> 0 THEN city END AS city_name
  FROM e
)
"""

_FLAT = """
flat AS (
  SELECT dt,
    temp AS temperatura_c,
    CAST(k AS DOUBLE) AS humedad_porcentaje,
    950.0::DOUBLE + k AS presion_hpa,
    wind AS velocidad_viento_m_s,
    CAST(NULL AS DOUBLE) AS direccion_viento_grados,
    CAST(NULL AS DOUBLE) AS uv_index,
    CAST(NULL AS DOUBLE) AS snow_1h_mm,
    CAST(NULL AS VARCHAR) AS timezone,
    CAST(NULL AS DOUBLE) AS visibility,
    CAST(NULL AS DOUBLE) AS nubes_porcentaje,
    CAST(NULL AS DOUBLE) AS rain_1h_mm,
    CAST(NULL AS VARCHAR) AS clima_descripcion_corta,
    CAST(NULL AS VARCHAR) AS clima_descripcion_larga,
    CAST(NULL AS VARCHAR) AS clima_icono_id,
    CAST(user_id % 5 - 40 AS DOUBLE) AS lat,
    CAST(user_id % 5 - 70 AS DOUBLE) AS lon,
    city AS city_name
  FROM e
)
"""

_RAW = "raw AS (SELECT * EXCLUDE (id) FROM nested UNION ALL BY NAME SELECT * FROM flat)"


def _silver_columns(source: str) -> str:
    return f"""
  SELECT dt AS timestamp_epoch,
    strftime(make_timestamp(dt * 1000000), '%Y-%m-%d %H:%M:%S') AS timestamp_iso,
    temperatura_c, humedad_porcentaje, presion_hpa, velocidad_viento_m_s, direccion_viento_grados,
    uv_index AS indice_uv, snow_1h_mm AS nieve_1h_mm, timezone, visibility, nubes_porcentaje,
    rain_1h_mm AS lluvia_1h_mm, clima_descripcion_corta, clima_descripcion_larga, clima_icono_id,
    lat, lon, city_name AS ciudad
  FROM {source}
  WHERE city_name IS NOT NULL AND temperatura_c IS NOT NULL AND dt IS NOT NULL
"""


_OBSERVED = """
obs AS (
  SELECT dt AS timestamp_epoch, iso AS timestamp_iso, temp AS temperatura_c,
    CAST(k AS DOUBLE) AS humedad_porcentaje, 950.0::DOUBLE + k AS presion_hpa,
    wind AS velocidad_viento_m_s, CAST(NULL AS DOUBLE) AS direccion_viento_grados,
    CASE WHEN event_type = 'view' THEN NULL ELSE CAST(k % 12 AS DOUBLE) END AS indice_uv,
    CAST(NULL AS DOUBLE) AS nieve_1h_mm, CAST(NULL AS VARCHAR) AS timezone,
    CAST(NULL AS DOUBLE) AS visibility,
    CASE WHEN event_type = 'signup' THEN NULL ELSE CAST(k AS DOUBLE) END AS nubes_porcentaje,
    rain AS lluvia_1h_mm,
    CAST(NULL AS VARCHAR) AS clima_descripcion_corta, CAST(NULL AS VARCHAR) AS clima_descripcion_larga,
    CAST(NULL AS VARCHAR) AS clima_icono_id,
    CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon, city AS ciudad
  FROM e WHERE temp IS NOT NULL
)
"""


def _indices(source: str) -> str:
    wind = _per_record("pow(coalesce(velocidad_viento_m_s, 0), 3) / 100")
    solar = _per_record("coalesce(indice_uv, 5.0::DOUBLE) * (1 - coalesce(nubes_porcentaje, 0) / 100)")
    return f"""
idx AS (
  SELECT *, {wind} AS wpi, {solar} AS spi, make_timestamp(timestamp_epoch * 1000000) AS t FROM {source}
)
"""


_DAILY = f"""
daily AS (
  SELECT ciudad, CAST(t AS DATE) AS fecha_solo,
    {_mean("wpi", places=2)} AS promedio_potencial_eolico_diario,
    max(wpi) AS max_potencial_eolico_diario,
    {_mean("spi", places=2)} AS promedio_potencial_solar_diario,
    max(spi) AS max_potencial_solar_diario,
    {_mean("temperatura_c")} AS promedio_temperatura_diaria_c,
    max(temperatura_c) AS max_temperatura_registro_c,
    min(temperatura_c) AS min_temperatura_registro_c,
    {_mean("humedad_porcentaje")} AS promedio_humedad_diaria,
    {_sum("coalesce(lluvia_1h_mm, 0)")} AS total_precipitacion_diaria_mm,
    max(velocidad_viento_m_s) AS max_velocidad_viento_m_s,
    {_mean("nubes_porcentaje")} AS promedio_nubes_diario
  FROM idx GROUP BY ALL
)
"""

_PATTERNS = f"""
patterns AS (
  SELECT *, ciudad || '-' || mes_anio || '-' || hora_solo AS id_analisis_patron
  FROM (
    SELECT ciudad, strftime(t, '%Y-%m') AS mes_anio, strftime(t, '%H') AS hora_solo,
      {_mean("wpi", places=2)} AS promedio_eolico_por_hora_mes,
      {_mean("spi", places=2)} AS promedio_solar_por_hora_mes,
      {_mean("temperatura_c")} AS promedio_temperatura_por_hora_mes,
      {_mean("humedad_porcentaje")} AS promedio_humedad_por_hora_mes
    FROM idx GROUP BY ALL
  )
)
"""

_GOLD_LINES = """
SELECT 'daily' AS tabla, ciudad, CAST(fecha_solo AS VARCHAR) AS periodo, CAST(NULL AS VARCHAR) AS hora,
  promedio_potencial_eolico_diario AS eolico, promedio_potencial_solar_diario AS solar,
  promedio_temperatura_diaria_c AS temperatura, promedio_humedad_diaria AS humedad,
  total_precipitacion_diaria_mm AS lluvia
FROM daily
UNION ALL
SELECT 'patterns', ciudad, mes_anio, hora_solo, promedio_eolico_por_hora_mes, promedio_solar_por_hora_mes,
  promedio_temperatura_por_hora_mes, promedio_humedad_por_hora_mes, NULL
FROM patterns
"""

_HOURS = f"""
hours AS (
  SELECT hora_solo,
    {_mean("promedio_eolico_por_hora_mes", 10)} AS promedio_eolico_por_hora_mes,
    {_mean("promedio_solar_por_hora_mes", 10)} AS promedio_solar_por_hora_mes
  FROM patterns GROUP BY hora_solo
)
"""

_HUMIDITY = f"""
humidity AS (
  SELECT ciudad, {_mean("promedio_humedad_diaria", 10)} AS promedio_humedad_diaria
  FROM daily GROUP BY ciudad
)
"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


_F2 = (_EVENTS, _OBSERVED)
_GOLD = (*_F2, _indices("obs"), _DAILY, _PATTERNS)
_FROM_NESTED = _with(_EVENTS, _NESTED)


def _city_means(*columns: str) -> str:
    """Means by city, and the city's place by the first of them."""
    means = ", ".join(f"{_mean(c, 10)} AS {c}" for c in columns)
    cities = f"SELECT ciudad, {means} FROM daily GROUP BY ciudad"
    return _with(*_GOLD) + f"SELECT *, row_number() OVER (ORDER BY {columns[0]} DESC NULLS LAST, ciudad) AS place FROM ({cities})"


def _top_day(section: str, metric: str, column: str, order: str, shown: str | None = None) -> str:
    return f"""
SELECT * FROM (
  SELECT '{section}' AS section, '{metric}' AS metric, ciudad, fecha_solo AS fecha,
    CAST(NULL AS VARCHAR) AS hora, {shown or column} AS value
  FROM daily ORDER BY {column} {order} NULLS LAST, ciudad, fecha_solo LIMIT 1
)
"""


_TOP_DAYS = "UNION ALL".join(
    (
        _top_day("extremes", "max_wind", "max_potencial_eolico_diario", "DESC"),
        _top_day("extremes", "max_solar", "max_potencial_solar_diario", "DESC"),
        _top_day("extremes", "min_mean_wind", "promedio_potencial_eolico_diario", "ASC"),
        _top_day("extremes", "min_mean_solar", "promedio_potencial_solar_diario", "ASC"),
        _top_day("rain_vs_solar", "rainiest_day", "total_precipitacion_diaria_mm", "DESC"),
        _top_day(
            "rain_vs_solar",
            "rainiest_day_solar",
            "total_precipitacion_diaria_mm",
            "DESC",
            "promedio_potencial_solar_diario",
        ),
        _top_day("conditions", "hottest_day", "max_temperatura_registro_c", "DESC"),
        _top_day("conditions", "coldest_day", "min_temperatura_registro_c", "ASC"),
    )
)


def _peak_hour(metric: str, column: str) -> str:
    return f"""
SELECT * FROM (
  SELECT 'hourly' AS section, '{metric}' AS metric, CAST(NULL AS VARCHAR) AS ciudad,
    CAST(NULL AS DATE) AS fecha, hora_solo AS hora, {_stable(column)} AS value
  FROM hours ORDER BY {column} DESC NULLS LAST, hora_solo LIMIT 1
)
"""


_PEAKS = "UNION ALL".join(
    (
        _peak_hour("peak_wind_hour", "promedio_eolico_por_hora_mes"),
        _peak_hour("peak_solar_hour", "promedio_solar_por_hora_mes"),
        f"""
SELECT * FROM (
  SELECT 'conditions' AS section, 'most_humid_city' AS metric, ciudad, CAST(NULL AS DATE) AS fecha,
    CAST(NULL AS VARCHAR) AS hora, {_stable("promedio_humedad_diaria")} AS value
  FROM humidity ORDER BY promedio_humedad_diaria DESC NULLS LAST, ciudad LIMIT 1
)
""",
    )
)

_REPORT = _with(*_GOLD, _HOURS, _HUMIDITY)

_STREAM_FIELDS = """
  'synthetic' AS source, city,
  CAST(user_id % 5 - 40 AS DOUBLE) AS lat, CAST(user_id % 5 - 70 AS DOUBLE) AS lon,
  dt * 1000 AS ts, replace(iso, ' ', 'T') || 'Z' AS datetime_utc, temp AS temp_c,
  CAST(k AS DOUBLE) AS humidity, 950.0::DOUBLE + k AS pressure, wind AS wind_speed
"""

_RAIN_FEEDS = {
    "both": "CASE WHEN event_id % 2 = 0 THEN value / 100 WHEN event_id % 3 = 0 THEN value / 50 END",
    "plain": "CASE WHEN event_id % 2 = 0 THEN value / 100 END",
    "prefixed": "CASE WHEN event_id % 3 = 0 THEN value / 50 END",
    "neither": "CAST(NULL AS DOUBLE)",
}

_ALL_GOLD = (_EVENTS, _NESTED, _FLAT, _RAW, f"obs AS ({_silver_columns('raw')})", _indices("obs"), _DAILY, _PATTERNS)


def _rejected(feed: str, source: str, number: str) -> str:
    """A line for each reason of a feed, by drop."""
    reasons = {"sin_ciudad": "city_name", "sin_temperatura": "temperatura_c", "sin_fecha": "dt"}
    return "UNION ALL".join(
        f"""
SELECT '{feed}' AS feed, CAST(({number}) % 3 AS BIGINT) AS "drop", '{reason}' AS motivo, count(*) AS filas
FROM {source} WHERE {column} IS NULL GROUP BY ALL
"""
        for reason, column in reasons.items()
    )


ORACLES: dict[str, str] = {
    "daily_summary": _with(*_GOLD) + "SELECT * FROM daily",
    "hourly_patterns": _with(*_GOLD) + "SELECT * FROM patterns",
    "gold_one_pass": _with(*_GOLD) + _GOLD_LINES,
    "time_columns": _with(*_F2)
    + """
SELECT ciudad, timestamp_epoch, temperatura_c, timestamp_iso AS fecha_hora_utc,
  CAST(CAST(timestamp_iso AS TIMESTAMP) AS DATE) AS fecha_solo,
  substr(timestamp_iso, 12, 2) AS hora_solo, substr(timestamp_iso, 1, 7) AS mes_anio
FROM obs
""",
    "energy_indices": _with(*_F2, _indices("obs"))
    + """
SELECT ciudad, timestamp_epoch, velocidad_viento_m_s, indice_uv, nubes_porcentaje,
  wpi AS potencial_eolico_index, spi AS potencial_solar_index
FROM idx
""",
    "flatten_nested": _FROM_NESTED + "SELECT * EXCLUDE (id) FROM nested",
    "flatten_flat": _with(_EVENTS, _FLAT)
    + """
SELECT flat.* REPLACE (dt - by_seconds AS dt), epoch_kind, epoch_shift
FROM flat, (VALUES ('ms_bigint'), ('ms_double'), ('s_by_name'), ('s_by_argument')) kinds(epoch_kind),
  (VALUES ('as_is', 0), ('in_1970', 1704067200), ('in_1960', 2019600000)) shifts(epoch_shift, by_seconds)
""",
    "precip_variants": _with(_EVENTS)
    + "UNION ALL".join(
        f"""
SELECT event_id AS id, '{feed}' AS feed, CASE WHEN event_type = 'purchase' THEN {rain} END AS rain_1h_mm,
  CASE WHEN event_type = 'click' THEN value / 200 END AS snow_1h_mm
FROM e
"""
        for feed, rain in _RAIN_FEEDS.items()
    ),
    "weather_first": _FROM_NESTED
    + """
SELECT id AS record, clima_descripcion_corta, clima_descripcion_larga, clima_icono_id FROM nested
""",
    "coord_coalesce": _FROM_NESTED + "SELECT id, lat, lon FROM nested",
    "union_sources": _with(_EVENTS, _NESTED, _FLAT, _RAW) + "SELECT * FROM raw",
    "silver_table": _with(_EVENTS, _NESTED, _FLAT, _RAW)
    + f"""
SELECT *, '2024' AS ingestion_year, '03' AS ingestion_month, '07' AS ingestion_day
FROM ({_silver_columns("raw")})
""",
    "quality_metrics": _FROM_NESTED
    + """
SELECT total_rows, clean_rows, total_rows - clean_rows AS rejected_rows
FROM (
  SELECT count(*) AS total_rows,
    count(*) FILTER (city_name IS NOT NULL AND temperatura_c IS NOT NULL AND dt IS NOT NULL) AS clean_rows
  FROM nested
)
""",
    "empty_gate": _with(
        _EVENTS,
        _NESTED,
        _FLAT,
        _RAW,
        "judged AS (SELECT city_name IS NOT NULL AND temperatura_c IS NOT NULL AND dt IS NOT NULL AS ok FROM raw)",
    )
    + """
SELECT 'all' AS batch, count(*) FILTER (ok) = 0 AS is_empty FROM judged
UNION ALL
SELECT 'rejected', count(*) FILTER (ok) = 0 FROM judged WHERE NOT ok
""",
    "preview": _with(*_F2)
    + """
SELECT ciudad, timestamp_iso, temperatura_c, lluvia_1h_mm, nieve_1h_mm, clima_descripcion_corta,
  clima_descripcion_larga
FROM obs ORDER BY timestamp_epoch, ciudad, temperatura_c LIMIT 5
""",
    "latest_observations": _with(*_F2)
    + """
SELECT * REPLACE (coalesce(lluvia_1h_mm, 0) AS lluvia_1h_mm),
  '2024' AS ingestion_year, '03' AS ingestion_month, '07' AS ingestion_day
FROM obs
""",
    "scan_mixed_schema": _FROM_NESTED
    + """
SELECT * EXCLUDE (id, raw_temp) REPLACE (
  CASE WHEN id % 3 = 2 THEN CAST(CAST(trunc(raw_temp) AS BIGINT) AS DOUBLE) ELSE temperatura_c END AS temperatura_c,
  CASE WHEN id % 3 <> 1 THEN rain_1h_mm END AS rain_1h_mm,
  CASE WHEN id % 3 <> 1 THEN snow_1h_mm END AS snow_1h_mm
)
FROM (SELECT nested.*, e.temp AS raw_temp FROM nested JOIN e ON nested.id = e.event_id),
  (VALUES ('forward'), ('backward')) orders(names)
""",
    "scan_parquet_recursive": _with(*_F2) + "SELECT * FROM obs",
    "scan_json_multiline": _FROM_NESTED + "SELECT * EXCLUDE (id) FROM nested",
    "silver_roundtrip": _with(*_F2)
    + "SELECT *, '2024' AS ingestion_year, '03' AS ingestion_month, '07' AS ingestion_day FROM obs",
    "gold_roundtrip": _with(*_GOLD) + _GOLD_LINES,
    "medallion_tables": _with(
        _EVENTS,
        _NESTED,
        _FLAT,
        _RAW,
        f"obs AS ({_silver_columns('raw')})",
        _indices("obs"),
        _DAILY,
        _PATTERNS,
    )
    + _GOLD_LINES,
    "silver_incremental": _with(_EVENTS, _NESTED, _FLAT, _RAW)
    + f"""
SELECT *, '2024' AS ingestion_year, '03' AS ingestion_month, '07' AS ingestion_day
FROM ({_silver_columns("raw")})
""",
    "rejected_rows": _with(_EVENTS, _NESTED, _FLAT) + _rejected("api", "nested", "id") + "UNION ALL" + _rejected("stream", "flat", "dt"),
    "gold_incremental": _with(*_ALL_GOLD) + _GOLD_LINES,
    "gold_replaced": _with(*_GOLD) + _GOLD_LINES,
    "json_shapes": _with(_EVENTS, _NESTED, _FLAT, _RAW) + "SELECT * FROM raw",
    "one_day": _with(*_F2)
    + """
SELECT ciudad, timestamp_epoch, temperatura_c, humedad_porcentaje, lluvia_1h_mm
FROM obs WHERE timestamp_epoch // 86400 = (SELECT min(timestamp_epoch) // 86400 + 3 FROM obs)
""",
    "compacted_silver": _with(*_F2)
    + """
SELECT CASE WHEN timestamp_epoch % 2 = 0 THEN '07' ELSE '08' END AS ingestion_day, ciudad, count(*) AS filas,
  sum(humedad_porcentaje) AS humedad, true AS compacted
FROM obs GROUP BY ALL
""",
    "stream_parse": _with(_EVENTS) + f"SELECT {_STREAM_FIELDS} FROM e",
    "stream_to_raw": _with(_EVENTS)
    + f"""
SELECT {_STREAM_FIELDS}, substr(iso, 1, 4) AS year, substr(iso, 6, 2) AS month, substr(iso, 9, 2) AS day
FROM e
""",
    "stream_resumed": _with(_EVENTS)
    + """
SELECT substr(iso, 1, 4) AS year, substr(iso, 6, 2) AS month, substr(iso, 9, 2) AS day, count(*) AS messages,
  true AS a_file_a_batch
FROM e GROUP BY ALL
""",
    "stream_rejected": _with(_EVENTS)
    + """,
judged AS (
  SELECT dt % 7 = 0 AS no_json, dt % 7 = 0 OR dt % 11 = 0 AS no_date, dt % 7 = 0 OR dt % 13 = 0 AS no_city FROM e
),
lines AS (
  SELECT 'aceptado' AS estado, CAST(NULL AS VARCHAR) AS motivo, count(*) AS filas FROM judged WHERE NOT (no_date OR no_city)
  UNION ALL SELECT 'rechazado', 'sin_json', count(*) FROM judged WHERE no_json
  UNION ALL SELECT 'rechazado', 'sin_fecha', count(*) FROM judged WHERE no_date
  UNION ALL SELECT 'rechazado', 'sin_ciudad', count(*) FROM judged WHERE no_city
)
SELECT *, filas AS observed FROM lines WHERE filas > 0
""",
    "payload_normalize": _with(_EVENTS)
    + """
SELECT 'openweather' AS source, CASE WHEN event_id % 50 <> 0 THEN city END AS city,
  CASE WHEN event_id % 10 <> 0 THEN CAST(user_id % 5 - 40 AS DOUBLE) END AS lat,
  CASE WHEN event_id % 10 <> 0 THEN CAST(user_id % 5 - 70 AS DOUBLE) END AS lon,
  CAST(1760885100000 AS BIGINT) AS ts, replace(iso, ' ', 'T') || 'Z' AS datetime_utc, temp AS temp_c,
  CAST(k AS DOUBLE) AS humidity, 950.0::DOUBLE + k AS pressure, wind AS wind_speed
FROM e WHERE event_id % 77 <> 0
""",
    "publish_json": _with(_EVENTS)
    + f"""
SELECT *, CAST(10 AS BIGINT) AS keys
FROM (SELECT {_STREAM_FIELDS} FROM e)
""",
    "hour_profile": _with(*_GOLD, _HOURS) + "SELECT *, row_number() OVER (ORDER BY hora_solo) AS place FROM hours",
    "city_potential": _city_means("max_potencial_eolico_diario", "max_potencial_solar_diario"),
    "city_temperature": _city_means("max_temperatura_registro_c", "min_temperatura_registro_c"),
    "city_humidity": _with(*_GOLD, _HUMIDITY) + "SELECT * FROM humidity",
    "rain_vs_solar": _with(*_GOLD)
    + "SELECT ciudad, total_precipitacion_diaria_mm, promedio_potencial_solar_diario FROM daily",
    "top_days": _with(*_GOLD) + _TOP_DAYS,
    "peaks": _REPORT + _PEAKS,
    "energy_report": _REPORT + _TOP_DAYS + "UNION ALL" + _PEAKS,
}
