"""Column builders that look a name up in a schema and never fail on its absence.

Raw feeds differ in shape, so each builder walks the frame's schema while the plan is
being built (no data is read) and falls back to a typed NULL. Casts are ``try_cast``: with
ANSI mode on, one dirty value must give NULL, not stop the job.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Path = Sequence[str]


def typed_null(dtype: str | T.DataType) -> Column:
    return F.lit(None).cast(dtype)


def lookup_type(schema: T.StructType, path: Path) -> T.DataType | None:
    """Type found at ``path`` (top-level name, then struct fields), or None."""
    node: T.DataType = schema
    for part in path:
        if not isinstance(node, T.StructType) or part not in node.fieldNames():
            return None
        node = node[part].dataType
    return node


def nested_field(path: Path) -> Column:
    """Column for a path of names; names may hold any character (``1h``, dots)."""
    head, *rest = path
    column = F.col("`" + head.replace("`", "``") + "`")
    for part in rest:
        column = column.getField(part)
    return column


def first_of(schema: T.StructType, paths: Iterable[Path], dtype: str | T.DataType) -> Column:
    """First non-NULL value among the paths the schema has, cast; typed NULL if it has none."""
    found = [nested_field(p).try_cast(dtype) for p in paths if lookup_type(schema, p) is not None]
    return F.coalesce(*found) if found else typed_null(dtype)


def field_or_null(schema: T.StructType, path: Path, dtype: str | T.DataType) -> Column:
    return first_of(schema, [path], dtype)


def ensure_columns(df: DataFrame, wanted: T.StructType) -> DataFrame:
    """Give ``df`` every wanted column in its wanted type, NULL where it had none."""
    return df.withColumns({f.name: field_or_null(df.schema, [f.name], f.dataType) for f in wanted})


def first_element_field(schema: T.StructType, array: str, field: str, dtype: str) -> Column:
    """Field of the first struct in an array; NULL for a NULL, empty or differently typed column."""
    array_type = lookup_type(schema, [array])
    if not isinstance(array_type, T.ArrayType):
        return typed_null(dtype)
    element = array_type.elementType
    if not isinstance(element, T.StructType) or field not in element.fieldNames():
        return typed_null(dtype)
    return F.get(nested_field([array]), F.lit(0)).getField(field).try_cast(dtype)
