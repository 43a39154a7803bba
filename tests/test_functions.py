"""Rounding, epoch arithmetic, indices and schema lookups."""

import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliovent.functions.columns import ensure_columns, first_element_field, first_of, lookup_type
from heliovent.functions.energy import cloud_factor, solar_index, wind_index
from heliovent.functions.rounding import exact_mean, exact_sum, round_cents, stable_round
from heliovent.functions.timekeys import epoch_seconds, hour_text, month_start, month_text, utc_date, utc_hour, utc_text


def values(spark, column, numbers):
    df = spark.createDataFrame([(i, float(n) if n is not None else None) for i, n in enumerate(numbers)], "i int, x double")
    return [r[0] for r in df.orderBy("i").select(column(F.col("x"))).collect()]


@pytest.mark.parametrize("rounding", [round_cents, stable_round])
def test_half_up_on_decimal_text(spark, rounding):
    assert values(spark, rounding, [1.005, 2.675, 0.125, -1.005, None]) == [1.01, 2.68, 0.13, -1.01, None]


def test_values_without_decimals_pass(spark):
    big = [math.inf, -math.inf, 1e30, -1e30, 123456789012345.67]
    for rounding in (round_cents, stable_round):
        assert values(spark, rounding, big) == values(spark, lambda x: F.round(x, 2), big)
        assert math.isnan(values(spark, rounding, [math.nan])[0])


def test_round_cents_is_spark_round(spark):
    rng = random.Random(7)
    xs = [rng.uniform(-1e7, 1e7) for _ in range(3000)] + [rng.uniform(-1, 1) for _ in range(3000)]
    xs += [round(rng.uniform(-300, 300), 3) for _ in range(3000)]  # many exact ties
    xs += [n / 1000 for n in range(-3005, 3005, 5)] + [0.0, -0.0, 1e-12, 999999.995, 1000000.005]
    assert values(spark, round_cents, xs) == values(spark, lambda x: F.round(x, 2), xs)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.floats(allow_nan=False, width=64), min_size=1, max_size=50))
def test_round_cents_on_any_double(spark, xs):
    assert values(spark, round_cents, xs) == values(spark, lambda x: F.round(x, 2), xs)


def test_exact_mean_ignores_order(spark):
    rng = random.Random(3)
    xs = [rng.choice([0.1, 0.2, 0.7, 12.345]) for _ in range(5000)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    means = {df.repartition(n).agg(exact_mean(F.col("x"), 10)).first()[0] for n in (1, 3, 8)}
    assert len(means) == 1
    assert means.pop() == pytest.approx(sum(xs) / len(xs))


def test_twenty_million_values_in_any_partitions(spark):
    """Doubles of this many values differ in the raw mean by more than rounding forgives."""

    def frame(parts):
        return spark.range(0, 20_000_000, 1, parts).select((F.pmod(F.xxhash64("id"), F.lit(199_999)) / 100 + 0.005).alias("x"))

    got = {frame(n).agg(exact_mean(F.col("x"), 10), exact_sum(F.col("x")), exact_mean(F.round("x", 2), 2, places=2)).first() for n in (2, 7, 64)}
    assert len(got) == 1


def test_exact_mean_rounds_once_and_leaves_nothing_out(spark):
    def mean(xs, **kw):
        return spark.createDataFrame([(x,) for x in xs], "x double").agg(exact_mean(F.col("x"), **kw)).first()[0]

    assert mean([0.01, 0.02], places=2) == 0.02  # a tie goes up
    assert mean([-0.01, -0.02], places=2) == -0.02
    assert mean([1.0, None]) == 1.0 and mean([None]) is None
    assert math.isnan(mean([1.0, math.nan])) and mean([1e30, 3e30]) == 2e30 and mean([math.inf, 1.0]) == math.inf


@pytest.mark.parametrize("zone", ["UTC", "America/Bogota", "Pacific/Auckland", "America/Sao_Paulo"])
def test_utc_text(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(1760841900,), (-1,), (0,), (None,)], "e bigint")
        got = [r[0] for r in df.select(utc_text(F.col("e"), "T", "Z")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == ["2025-10-19T02:45:00Z", "1969-12-31T23:59:59Z", "1970-01-01T00:00:00Z", None]


def test_stable_round_drops_summation_noise(spark):
    assert values(spark, stable_round, [12.344999999999999, 12.345000000000001]) == [12.35, 12.35]


@pytest.mark.parametrize("zone", ["UTC", "America/Bogota", "Pacific/Auckland"])
def test_calendar_keys_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(1760841900,), (-1,), (0,), (86399,), (None,)], "e bigint")
        e = F.col("e")
        rows = df.select(
            utc_date(e).cast("string"),
            hour_text(utc_hour(e)),
            month_text(month_start(utc_date(e))),
        ).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [tuple(r) for r in rows] == [
        ("2025-10-19", "02", "2025-10"),
        ("1969-12-31", "23", "1969-12"),
        ("1970-01-01", "00", "1970-01"),
        ("1970-01-01", "23", "1970-01"),
        (None, None, None),
    ]


def test_absurd_epoch_gives_no_date(spark):
    df = spark.createDataFrame([(9_000_000_000_000_000_000,)], "e bigint")
    assert df.select(utc_date(F.col("e"))).first()[0] is None


@pytest.mark.parametrize(
    "type_name, given, unit, expected",
    [
        ("bigint", 1760841900000, "ms", 1760841900),
        ("bigint", 1760841900999, "ms", 1760841900),
        ("bigint", 50_000_000_000, "ms", 50_000_000),  # August 1971
        ("bigint", 50_000_000_000, "s", 50_000_000_000),
        ("bigint", -200_000_000_000, "ms", -200_000_000),
        ("bigint", 1760841900, "s", 1760841900),
        ("double", 1760841900000.0, "ms", 1760841900),
        ("double", math.nan, "ms", None),
        ("int", 1760841900, "s", 1760841900),
        ("string", "1760841900000", "ms", 1760841900),
        ("string", "yesterday", "s", None),
        ("bigint", None, "s", None),
    ],
)
def test_epoch_seconds(spark, type_name, given, unit, expected):
    df = spark.createDataFrame([(given,)], f"ts {type_name}")
    assert df.select(epoch_seconds(F.col("ts"), unit)).first()[0] == expected


def test_only_seconds_and_milliseconds():
    with pytest.raises(ValueError, match="minutes"):
        epoch_seconds(F.lit(1), "minutes")


def test_wind_index(spark):
    assert values(spark, wind_index, [10.0, None, 0.0, 3.37]) == [10.0, 0.0, 0.0, 0.38]


def test_solar_index(spark):
    df = spark.createDataFrame([(8.0, 25.0), (None, None), (8.0, 100.0), (8.0, None), (None, 50.0)], "u double, c double")
    got = [r[0] for r in df.select(solar_index(F.col("u"), F.col("c"))).collect()]
    assert got == [6.0, 5.0, 0.0, 8.0, 2.5]
    assert [r[0] for r in df.select(cloud_factor(F.col("c"))).collect()] == [0.75, 1.0, 0.0, 1.0, 0.5]


def test_lookup_and_first_of(spark):
    df = spark.createDataFrame([((None, "2.5"), 7), (("1.5", "x"), 8)], "rain struct<`1h`: string, `_1h`: string>, `a.b` int")
    assert lookup_type(df.schema, ["rain", "1h"]) == T.StringType()
    assert lookup_type(df.schema, ["rain", "3h"]) is None
    assert lookup_type(df.schema, ["a.b", "c"]) is None
    amount = first_of(df.schema, [("rain", "1h"), ("rain", "_1h"), ("snow", "1h")], "double")
    assert [r[0] for r in df.select(amount).collect()] == [2.5, 1.5]
    assert [r[0] for r in df.select(first_of(df.schema, [("a.b",)], "bigint")).collect()] == [7, 8]
    assert [r[0] for r in df.select(first_of(df.schema, [("none",)], "double")).collect()] == [None, None]


def test_first_element_field(spark):
    ddl = "w array<struct<main: string, code: int>>"
    df = spark.createDataFrame([([("a", 1), ("b", 2)],), ([],), (None,), ([None],)], ddl)
    assert [r[0] for r in df.select(first_element_field(df.schema, "w", "main", "string")).collect()] == ["a", None, None, None]
    assert [r[0] for r in df.select(first_element_field(df.schema, "w", "code", "string")).collect()] == ["1", None, None, None]
    assert [r[0] for r in df.select(first_element_field(df.schema, "w", "gone", "string")).collect()] == [None] * 4
    text = spark.createDataFrame([("rain",)], "w string")
    assert text.select(first_element_field(text.schema, "w", "main", "string")).first()[0] is None


def test_ensure_columns(spark):
    df = spark.createDataFrame([(1, "x")], "timezone int, other string")
    wanted = T.StructType([T.StructField("timezone", T.StringType()), T.StructField("uv_index", T.DoubleType())])
    got = ensure_columns(df, wanted)
    assert got.dtypes == [("timezone", "string"), ("other", "string"), ("uv_index", "double")]
    assert got.first() == ("1", "x", None)
