"""Shapes and spellings of raw records."""

import pytest
from pyspark.sql import functions as F

from heliovent.operators.normalise import flatten_flat, flatten_nested, is_nested, normalise, union_sources
from heliovent.schemas import NORMALISED

NESTED = (
    "id bigint, dt bigint, name string, main struct<temp: double, humidity: bigint, pressure: double>, "
    "wind struct<speed: double, deg: bigint>, coord struct<lat: double, lon: double>, "
    "clouds struct<all: bigint>, rain struct<`1h`: double>, snow struct<`_1h`: double>, "
    "weather array<struct<main: string, description: string, icon: string>>, "
    "timezone bigint, visibility bigint, _airbyte_raw_id string, cod bigint, base string, sys struct<country: string>, "
    "station_code string"
)
RECORD = (
    1, 1760841900, "Riohacha", (30.005, 70, 1010.5), (3.375, 90), (11.5, -72.9), (40,), (0.4,), (None,),
    [("Rain", "light rain", "10d"), ("Mist", "mist", "50d")],
    -18000, 10000, "uuid", 200, "stations", ("CO",), "s-1",
)


@pytest.fixture()
def nested(spark):
    return spark.createDataFrame([RECORD], NESTED)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0].asDict()


def test_nested_record(nested):
    assert is_nested(nested)
    row = one(normalise(nested))
    assert row == {
        "dt": 1760841900,
        "temperatura_c": 30.01,
        "humedad_porcentaje": 70.0,
        "presion_hpa": 1010.5,
        "velocidad_viento_m_s": 3.38,
        "direccion_viento_grados": 90.0,
        "uv_index": None,
        "snow_1h_mm": None,
        "timezone": "-18000",
        "visibility": 10000.0,
        "nubes_porcentaje": 40.0,
        "rain_1h_mm": 0.4,
        "clima_descripcion_corta": "Rain",
        "clima_descripcion_larga": "light rain",
        "clima_icono_id": "10d",
        "lat": 11.5,
        "lon": -72.9,
        "city_name": "Riohacha",
    }


def test_flatten_drops_structs_and_metadata_and_keeps_the_rest(nested):
    columns = set(flatten_nested(nested).columns)
    gone = {"main", "wind", "coord", "clouds", "rain", "snow", "weather", "_airbyte_raw_id", "id", "cod", "sys", "base", "name"}
    assert not columns & gone
    assert "station_code" in columns
    assert columns >= set(NORMALISED.fieldNames())


@pytest.mark.parametrize(
    "absent, nulls",
    [
        (["wind"], ["velocidad_viento_m_s", "direccion_viento_grados"]),
        (["coord"], ["lat", "lon"]),
        (["rain"], ["rain_1h_mm"]),
        (["snow"], ["snow_1h_mm"]),
        (["weather"], ["clima_descripcion_corta", "clima_descripcion_larga", "clima_icono_id"]),
        (["dt"], ["dt"]),
        (["clouds"], ["nubes_porcentaje"]),
        (["name"], ["city_name"]),
        (["timezone", "visibility"], ["timezone", "visibility"]),
    ],
)
def test_nested_record_without(nested, absent, nulls):
    full = one(normalise(nested))
    part = normalise(nested.drop(*absent))
    assert part.schema == normalise(nested).schema
    assert one(part) == {**full, **dict.fromkeys(nulls)}


def test_fields_absent_inside_structs(spark):
    df = spark.createDataFrame([((20.0,), (5.0,), "X", 10)], "main struct<temp: double>, wind struct<speed: double>, name string, dt int")
    row = one(normalise(df))
    assert (row["temperatura_c"], row["velocidad_viento_m_s"]) == (20.0, 5.0)
    assert row["humedad_porcentaje"] is None and row["direccion_viento_grados"] is None


def test_coordinates_fall_back_by_value(nested):
    fallback = nested.withColumns({"lat": F.lit(-1.0), "lon": F.lit(-2.0)})
    assert one(normalise(fallback))["lat"] == 11.5
    empty = fallback.withColumn("coord", F.lit(None).cast("struct<lat: double, lon: double>"))
    row = one(normalise(empty))
    assert (row["lat"], row["lon"]) == (-1.0, -2.0)
    assert one(normalise(fallback.drop("coord")))["lat"] == -1.0


@pytest.mark.parametrize(
    "kind, value, expected",
    [
        ("struct<`1h`: double, `_1h`: double>", (1.0, 2.0), 1.0),
        ("struct<`1h`: double, `_1h`: double>", (None, 2.0), 2.0),
        ("struct<`_1h`: int>", (2,), 2.0),
        ("struct<`3h`: double>", (3.0,), None),
        ("double", 5.0, None),
        ("string", "wet", None),
    ],
)
def test_rain_spellings(spark, nested, kind, value, expected):
    for column, target in (("rain", "rain_1h_mm"), ("snow", "snow_1h_mm")):
        amount = spark.createDataFrame([(1, value)], f"id bigint, {column} {kind}")
        df = nested.drop(column).join(amount, "id")
        assert one(normalise(df))[target] == expected


def test_dirty_text_becomes_null(spark):
    df = spark.createDataFrame(
        [(("hot", "70"), "soon", "A")], "main struct<temp: string, humidity: string>, dt string, name string"
    )
    row = one(normalise(df))
    assert (row["temperatura_c"], row["humedad_porcentaje"], row["dt"]) == (None, 70.0, None)


FLAT = "source string, city string, lat double, lon double, ts bigint, temp_c double, humidity double, pressure double, wind_speed double"


def test_flat_record_of_the_stream(spark):
    df = spark.createDataFrame([("s", "Patagonia", -41.0, -70.0, 1760841900000, 8.123, 55.0, 1000.0, 7.777)], FLAT)
    assert not is_nested(df)
    row = one(normalise(df))
    assert row["dt"] == 1760841900
    assert row["city_name"] == "Patagonia"
    assert row["temperatura_c"] == 8.123, "flat records are not rounded"
    assert row["velocidad_viento_m_s"] == 7.777
    assert row["clima_icono_id"] is None and row["timezone"] is None


def test_flat_optional_columns(spark):
    df = spark.createDataFrame(
        [("A", 1760841900, 1, 2.0, 0.5, 0.25, 30, "x", 3)],
        "city string, dt int, temp_c int, wind_deg double, rain_1h double, snow_1h double, `all` int, clima_icono_id string, timezone int",
    )
    row = one(normalise(df))
    assert row["dt"] == 1760841900 and row["temperatura_c"] == 1.0
    assert row["direccion_viento_grados"] == 2.0 and row["rain_1h_mm"] == 0.5 and row["snow_1h_mm"] == 0.25
    assert row["nubes_porcentaje"] == 30.0 and row["clima_icono_id"] == "x" and row["timezone"] == "3"
    assert "all" not in flatten_flat(df).columns


def test_flat_record_with_old_and_new_names(spark):
    df = spark.createDataFrame(
        [(1, 2000, 1.0, 9.0), (None, 2000, None, 9.0)], "dt bigint, ts bigint, temperatura_c double, temp_c double"
    )
    rows = normalise(df).select("dt", "temperatura_c").collect()
    assert [tuple(r) for r in rows] == [(1, 1.0), (2, 9.0)]


@pytest.mark.parametrize("column", ["city_name", "name", "city"])
@pytest.mark.parametrize("nested_shape", [True, False])
def test_city_spellings(spark, column, nested_shape):
    shape = "main struct<temp: double>" if nested_shape else "temp_c double"
    df = spark.createDataFrame([("Riohacha", (1.0,) if nested_shape else 1.0)], f"{column} string, {shape}")
    assert one(normalise(df))["city_name"] == "Riohacha"


def test_city_name_wins_over_the_other_spellings(spark):
    df = spark.createDataFrame([("c", "n", "cn"), ("c", "n", None), ("c", None, None)], "city string, name string, city_name string")
    assert [r[0] for r in normalise(df).select("city_name").collect()] == ["cn", "n", "c"]


def test_union_of_sources_with_conflicting_types(spark, nested):
    """Text and number time zones, integer and double measures: all are pinned before the union."""
    other = spark.createDataFrame([("Bogota", 14, "America/Bogota", 80)], "city string, temp_c int, timezone string, humidity int")
    both = union_sources([normalise(nested), normalise(other)])
    assert both.schema == NORMALISED or [f.dataType for f in both.schema] == [f.dataType for f in NORMALISED]
    assert {r["timezone"] for r in both.collect()} == {"-18000", "America/Bogota"}


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([(1, "x")], "i int, s string")
    b = spark.createDataFrame([(2, 2.5)], "i bigint, d double")
    got = union_sources([a, b]).orderBy("i")
    assert got.dtypes == [("i", "bigint"), ("s", "string"), ("d", "double")]
    assert [tuple(r) for r in got.collect()] == [(1, "x", None), (2, None, 2.5)]
