"""Records held as VARIANT: each is nested or flat by itself, whatever the others of its file are."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliovent.operators.normalise import CITY_NAMES, EPOCH_UNITS, FLAT_NAMES, flat_columns, nested_columns
from heliovent.schemas import NORMALISED

# Fields of the nested API record that normalised columns come from.
_NESTED_FIELDS = {
    "main": ("temp", "humidity", "pressure"),
    "wind": ("speed", "deg"),
    "coord": ("lat", "lon"),
    "clouds": ("all",),
    "rain": ("1h", "_1h"),
    "snow": ("1h", "_1h"),
}
_WEATHER_FIELDS = ("main", "description", "icon")


def _get(path: str, kind: str) -> Column:
    """A field of the record, NULL where it is missing or does not fit the type."""
    return F.try_variant_get("record", path, kind)


def _typed_fields() -> dict[str, Column]:
    """All fields that either shape may have, as columns of the names and structs that the raw tables have."""
    kinds = {f.name: f.dataType.simpleString() for f in NORMALISED}
    kinds |= {old: kinds[new] for old, new in FLAT_NAMES.items()}
    kinds |= dict.fromkeys(CITY_NAMES, "string") | dict.fromkeys(EPOCH_UNITS, "bigint")
    fields = {name: _get(f'$["{name}"]', kind) for name, kind in kinds.items()}
    for struct, names in _NESTED_FIELDS.items():
        fields[struct] = F.struct(*[_get(f'$["{struct}"]["{name}"]', "double").alias(name) for name in names])
    first = F.struct(*[_get(f'$["weather"][0]["{name}"]', "string").alias(name) for name in _WEATHER_FIELDS])
    return fields | {"weather": F.array(first)}


def _is_fraction(name: str) -> Column:
    kind = F.schema_of_variant(_get(f'$["{name}"]', "variant"))
    return F.coalesce(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), F.lit(False))


def normalise_records(records: DataFrame, carry: Iterable[str] = ()) -> DataFrame:
    """``record`` -> the normalised columns, then those to ``carry`` along; the rules are those of ``normalise``, record by record.

    A record with ``main`` is nested, any other flat. A fractional time of a flat record is in milliseconds.
    """
    typed = records.select(*carry, "record", *[c.alias(name) for name, c in _typed_fields().items()])
    nested = _get('$["main"]', "variant").isNotNull()
    own = {f.name: F.col(f.name) for f in NORMALISED}
    of_nested = own | nested_columns(typed.schema)
    of_flat = flat_columns(typed.schema)
    seconds = F.when(_is_fraction("dt"), (F.col("dt") / 1000).try_cast("bigint")).otherwise(F.col("dt"))
    of_flat["dt"] = F.coalesce(seconds, (F.col("ts") / 1000).try_cast("bigint"))
    columns = [F.when(nested, of_nested[name]).otherwise(of_flat[name]).alias(name) for name in NORMALISED.fieldNames()]
    return typed.select(*columns, *carry)
