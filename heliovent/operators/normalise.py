"""Bring nested API records and flat records to one set of typed columns."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliovent.functions.columns import (
    ensure_columns,
    field_or_null,
    first_element_field,
    first_of,
    lookup_type,
    nested_field,
    typed_null,
)
from heliovent.functions.rounding import round_cents
from heliovent.functions.timekeys import epoch_seconds
from heliovent.schemas import NORMALISED

# Structs of the API record that are spent once flattened.
NESTED_COLUMNS = ("main", "wind", "coord", "clouds", "rain", "weather", "snow")

# Columns that ingestion tools and the API add and no table keeps.
METADATA_COLUMNS = (
    "_airbyte_raw_id",
    "_airbyte_extracted_at",
    "_airbyte_emitted_at",
    "_airbyte_ab_id",
    "_airbyte_normalized_at",
    "_airbyte_meta",
    "_airbyte_generation_id",
    "id",
    "cod",
    "sys",
    "base",
    "name",
)

# Names in flat feeds -> names in the normalised table.
FLAT_NAMES = {
    "ts": "dt",
    "temp_c": "temperatura_c",
    "humidity": "humedad_porcentaje",
    "pressure": "presion_hpa",
    "wind_speed": "velocidad_viento_m_s",
    "wind_deg": "direccion_viento_grados",
    "rain_1h": "rain_1h_mm",
    "snow_1h": "snow_1h_mm",
    "all": "nubes_porcentaje",
}

# Columns that may carry the city, best first.
CITY_NAMES = ("city_name", "name", "city")

_OPTIONAL_FLAT = T.StructType([NORMALISED[c] for c in ("uv_index", "visibility", "timezone")])


def is_nested(df: DataFrame) -> bool:
    """Nested API shape, told by the presence of ``main``."""
    return "main" in df.columns


def city_name(schema: T.StructType) -> Column:
    return first_of(schema, [(name,) for name in CITY_NAMES], "string")


def coordinate(schema: T.StructType, axis: str) -> Column:
    """``lat`` or ``lon``: from the coordinate struct, else from the top level."""
    return first_of(schema, [("coord", axis), (axis,)], "double")


def one_hour_amount(schema: T.StructType, struct: str) -> Column:
    """Millimetres of ``rain`` or ``snow`` in the last hour; feeds spell the field two ways."""
    return first_of(schema, [(struct, "1h"), (struct, "_1h")], "double")


def nested_columns(schema: T.StructType) -> dict[str, Column]:
    """What a nested API record gives for the normalised columns, but for those it has under their own names."""

    def measure(*path: str) -> Column:
        return field_or_null(schema, path, "double")

    return {
        "city_name": city_name(schema),
        "dt": field_or_null(schema, ["dt"], "bigint"),
        "temperatura_c": round_cents(measure("main", "temp")),
        "humedad_porcentaje": measure("main", "humidity"),
        "presion_hpa": measure("main", "pressure"),
        "velocidad_viento_m_s": round_cents(measure("wind", "speed")),
        "direccion_viento_grados": measure("wind", "deg"),
        "lat": coordinate(schema, "lat"),
        "lon": coordinate(schema, "lon"),
        "nubes_porcentaje": measure("clouds", "all"),
        "rain_1h_mm": one_hour_amount(schema, "rain"),
        "snow_1h_mm": one_hour_amount(schema, "snow"),
        "clima_descripcion_corta": first_element_field(schema, "weather", "main", "string"),
        "clima_descripcion_larga": first_element_field(schema, "weather", "description", "string"),
        "clima_icono_id": first_element_field(schema, "weather", "icon", "string"),
    }


def flatten_nested(df: DataFrame) -> DataFrame:
    """Nested API record -> flat columns; columns unknown to us pass through."""
    flat = nested_columns(df.schema)
    spent = [c for c in NESTED_COLUMNS + METADATA_COLUMNS if c not in flat]
    return ensure_columns(df.withColumns(flat).drop(*spent), _OPTIONAL_FLAT)


# The unit of each time column that a flat feed may have.
EPOCH_UNITS = {"dt": "s", "ts": "ms"}


def epoch_unit(schema: T.StructType, name: str) -> str:
    """Unit of a feed's time column: floating-point ones are milliseconds, else it goes by the name."""
    return "ms" if schema[name].dataType.typeName() in ("double", "float") else EPOCH_UNITS[name]


def _flat_epoch(schema: T.StructType, unit: str | None) -> Column:
    found = [
        epoch_seconds(nested_field([name]), unit or epoch_unit(schema, name))
        for name in EPOCH_UNITS
        if lookup_type(schema, [name]) is not None
    ]
    return F.coalesce(*found) if found else typed_null("bigint")


def flat_columns(schema: T.StructType, unit: str | None = None) -> dict[str, Column]:
    """What a flat record gives for the normalised columns."""
    old_name = {new: old for old, new in FLAT_NAMES.items()}
    flat = {
        f.name: first_of(schema, [(f.name,), (old_name.get(f.name, f.name),)], f.dataType)
        for f in NORMALISED
    }
    flat["dt"] = _flat_epoch(schema, unit)
    flat["city_name"] = city_name(schema)
    return flat


def flatten_flat(df: DataFrame, unit: str | None = None) -> DataFrame:
    """Flat record -> normalised names and types. ``unit`` (``s``, ``ms``): of the feed's time, where it is not the usual one.

    A record may hold both the old and the new name of a column; the new one wins where it
    is not NULL.
    """
    flat = flat_columns(df.schema, unit)
    spent = [c for c in (*FLAT_NAMES, "name", "city") if c not in flat]
    return df.withColumns(flat).drop(*spent)


def normalise(df: DataFrame, unit: str | None = None, carry: Iterable[str] = ()) -> DataFrame:
    """Any raw source -> the normalised columns, typed and in order, ready for a union, then those to ``carry`` along.

    ``unit``: see ``flatten_flat``.
    """
    flat = flatten_nested(df) if is_nested(df) else flatten_flat(df, unit)
    return flat.select(*NORMALISED.fieldNames(), *carry)


def union_sources(frames: Iterable[DataFrame]) -> DataFrame:
    """UNION ALL by name; columns missing in a frame become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
