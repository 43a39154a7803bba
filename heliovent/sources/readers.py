"""Readers of raw, silver and gold tables."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heliovent.operators.normalise import normalise, union_sources
from heliovent.operators.quality import require_rows
from heliovent.schemas import ACCEPTED, GOLD_DAILY, GOLD_PATTERNS, REJECTED, SILVER, SILVER_BATCHES
from heliovent.sources import folders

log = logging.getLogger(__name__)

# Error classes that say that a source is not there or has no readable schema; anything else fails the job.
_NOT_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "FAILED_READ_FILE.CANNOT_READ_FILE_FOOTER", "EMPTY_SCHEMA_NOT_SUPPORTED_FOR_DATASOURCE")
_UNLIKE_FILES = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")


class NoSourceError(RuntimeError):
    """None of the given sources could be loaded, or a required one could not."""


def read_recursive_parquet(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    partitioned: bool = False,
) -> DataFrame:
    """All Parquet files below ``path``, at any depth, without partition columns.

    Without ``schema`` it is that of all files together, merged by Spark: a column that only some files have is NULL in
    the others. Files that give a column unlike types cannot make one frame; see ``read_unlike_parquet``.
    ``partitioned=True`` discovers the partition columns instead, so that a filter on the day
    reads only that day's folders.
    """
    reader = spark.read.option("basePath", path)
    if not partitioned:
        reader = reader.option("recursiveFileLookup", True)
    reader = reader.option("mergeSchema", True) if schema is None else reader.schema(schema)
    return reader.parquet(path)


def _error_of(error: Exception, classes: tuple[str, ...]) -> bool:
    """Whether the error or one of its causes is of these classes."""
    condition = error.getCondition() or "" if isinstance(error, PySparkException) else ""
    return any(name == condition or f"[{name}" in str(error) for name in classes)


def _agree(a: T.DataType, b: T.DataType) -> bool:
    """Whether Spark's schema merge takes both: equal types, or structs, arrays and maps of such."""
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return all(_agree(a[name].dataType, b[name].dataType) for name in set(a.names) & set(b.names))
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return _agree(a.elementType, b.elementType)
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return _agree(a.keyType, b.keyType) and _agree(a.valueType, b.valueType)
    return a == b


def _united(a: T.DataType, b: T.DataType) -> T.DataType:
    """The merge of two types that agree."""
    if isinstance(a, T.StructType):
        both = [T.StructField(f.name, _united(f.dataType, b[f.name].dataType) if f.name in b.names else f.dataType) for f in a]
        return T.StructType(both + [f for f in b if f.name not in a.names])
    if isinstance(a, T.ArrayType):
        return T.ArrayType(_united(a.elementType, b.elementType))
    if isinstance(a, T.MapType):
        return T.MapType(_united(a.keyType, b.keyType), _united(a.valueType, b.valueType))
    return a


def like_groups(files: Sequence[str], schema_of: Callable[[Sequence[str]], T.StructType | None]) -> list[tuple[list[str], T.StructType]]:
    """Files in groups whose types agree, each with its merged schema.

    ``schema_of`` merges the footers of a list of files, or gives None where they conflict. A list that conflicts is
    halved; groups that agree are joined again, so there are as many as real conflicts ask for. Writers put files of
    one kind side by side, so the cost is about two merges for each place where neighbours in the list differ.
    """
    groups: list[tuple[list[str], T.StructType]] = []

    def add(own: list[str], schema: T.StructType) -> None:
        for i, (others, known) in enumerate(groups):
            if _agree(known, schema):
                groups[i] = (others + own, _united(known, schema))
                return
        groups.append((own, schema))

    todo = [list(files)] if files else []
    while todo:
        part = todo.pop()
        schema = schema_of(part)
        if schema is not None:
            add(part, schema)
        else:
            half = len(part) // 2
            todo += [part[half:], part[:half]]
    return groups


def _merged_schema(spark: SparkSession, files: Sequence[str]) -> T.StructType | None:
    try:
        return spark.read.option("mergeSchema", True).parquet(*files).schema
    except (PySparkException, Py4JJavaError) as error:
        if len(files) > 1 and _error_of(error, _UNLIKE_FILES):
            return None
        raise


def read_unlike_parquet(spark: SparkSession, path: str) -> list[DataFrame]:
    """All Parquet files below ``path``: one frame, or one for each group of files with the same types.

    Groups are needed only where files give a column unlike types, such as a measure that is a whole number in some. They are
    found from footers alone (``like_groups``, by Spark's own footer merge); no rows are read.
    """
    try:
        return [read_recursive_parquet(spark, path)]
    except (PySparkException, Py4JJavaError) as error:
        if not _error_of(error, _UNLIKE_FILES):
            raise
    # a pinned schema of no interest: listing the files then reads none of them
    listed = read_recursive_parquet(spark, path, T.StructType([T.StructField("any", T.StringType())])).inputFiles()
    return read_like_groups(spark, sorted(map(unquote, listed)))


def read_like_groups(spark: SparkSession, files: Sequence[str]) -> list[DataFrame]:
    """These Parquet files, a frame for each group of ``like_groups``."""
    groups = like_groups(files, lambda part: _merged_schema(spark, part))
    return [spark.read.schema(schema).parquet(*paths) for paths, schema in groups]


def read_multiline_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON documents that span lines (an object or an array of objects per file).

    Without ``schema`` all files are read once more to infer it. A file is read by one task, since such a document
    cannot be split.
    """
    reader = spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_json_records(spark: SparkSession, *paths: str) -> DataFrame:
    """JSON documents of any shapes, one row a record: ``record`` (VARIANT) and ``archivo``.

    Nothing is inferred, so files are read once. A document is an object or an array of objects; what is no JSON is one NULL record.
    """
    reader = spark.read.option("singleVariantColumn", "document").option("multiLine", True).option("mode", "PERMISSIVE")
    documents = reader.json(list(paths)).select("document", F.col("_metadata.file_path").alias("archivo"))
    items = F.coalesce(F.try_variant_get("document", "$", "array<variant>"), F.array("document"))
    return documents.select(F.explode(items).alias("record"), "archivo")


def _pinned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    # Partition columns come last in a scan; the select restores the order of the schema.
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def read_silver(spark: SparkSession, path: str) -> DataFrame:
    """Silver with its pinned schema: inference would turn the partition text ``01`` into 1."""
    return _pinned(spark, path, SILVER)


def read_batches(spark: SparkSession, path: str, lotes: Sequence[str] | None = None) -> DataFrame:
    """Silver written batch by batch, accepted and rejected rows with their state, batch, file and reasons; ``lotes``: of these only."""
    rows = _pinned(spark, path, SILVER_BATCHES)
    return rows if lotes is None else rows.where(F.col("lote").isin(list(lotes)))


def read_accepted(spark: SparkSession, path: str, lotes: Sequence[str] | None = None) -> DataFrame:
    return read_batches(spark, path, lotes).where(F.col("estado") == ACCEPTED).select(*SILVER.fieldNames(), "lote")


def read_rejected(spark: SparkSession, path: str, lotes: Sequence[str] | None = None) -> DataFrame:
    """Rows that broke a rule of quality, with all the rules they broke and the file they came from."""
    return read_batches(spark, path, lotes).where(F.col("estado") == REJECTED).drop("estado")


def _read_gold(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    table = _pinned(spark, folders.current(spark, path), schema)
    require_rows(table, f"gold table {path}")
    return table


def read_daily(spark: SparkSession, path: str) -> DataFrame:
    return _read_gold(spark, path, GOLD_DAILY)


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    return _read_gold(spark, path, GOLD_PATTERNS)


def load_sources(
    spark: SparkSession,
    parquet: Iterable[str] = (),
    json: Iterable[str] = (),
    json_schema: T.StructType | None = None,
    parquet_schema: T.StructType | None = None,
    required: Iterable[str] = (),
) -> tuple[DataFrame, dict[str, str]]:
    """Load and normalise every source; skip those that are missing or have no readable schema.

    Returns the union of the loaded sources and ``{path: reason}`` of the skipped ones. A path in ``required`` must load.
    Reads are lazy, so this catches what shows while planning; any other error, such as a fault of the store, and a
    file that breaks later fail the job, since tables written without a source would pass for whole.
    """

    def parquet_source(path: str) -> list[DataFrame]:
        return read_unlike_parquet(spark, path) if parquet_schema is None else [read_recursive_parquet(spark, path, parquet_schema)]

    def json_source(path: str) -> list[DataFrame]:
        return [read_multiline_json(spark, path, json_schema)]

    loaded: list[DataFrame] = []
    skipped: dict[str, str] = {}
    required = set(required)
    for read, path in [*((parquet_source, p) for p in parquet), *((json_source, p) for p in json)]:
        try:
            loaded += map(normalise, read(path))
        except AnalysisException as error:
            skipped[path] = str(error)
        except (PySparkException, Py4JJavaError) as error:
            if not _error_of(error, _NOT_THERE):
                raise
            skipped[path] = str(error)
        if path in skipped:
            if path in required:
                raise NoSourceError(f"required source {path}: {skipped[path]}")
            log.error("skipped source %s: %s", path, skipped[path])
    if not loaded:
        raise NoSourceError(f"no source could be loaded: {skipped}")
    return union_sources(loaded), skipped
