"""Folders of any Hadoop-compatible store, and tables in versions of which one is current.

A versioned table keeps each write in a folder of its own. A mark named like that folder is created once the write is
complete; the last mark names the version to read. Until then, and if the write dies, readers see the version before.
Marks are new empty files, so this asks no rename or overwrite of the store.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

MARKS = "_versions"  # Spark's readers leave out names that start with an underscore


def _place(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where it does not exist."""
    place, store = _place(spark, path)
    return sorted(s.getPath().getName() for s in store.listStatus(place)) if store.exists(place) else []


def exists(spark: SparkSession, path: str) -> bool:
    place, store = _place(spark, path)
    return store.exists(place)


def mark(spark: SparkSession, path: str) -> None:
    """An empty file, new or again."""
    place, store = _place(spark, path)
    store.create(place, True).close()


def delete(spark: SparkSession, path: str) -> None:
    place, store = _place(spark, path)
    store.delete(place, True)


def versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of a table, oldest first."""
    return children(spark, f"{path.rstrip('/')}/{MARKS}")


def current(spark: SparkSession, path: str) -> str:
    """The folder to read: the last complete version's, or ``path`` itself for a table without versions."""
    complete = versions(spark, path)
    return f"{path.rstrip('/')}/{complete[-1]}" if complete else path


def next_version(spark: SparkSession, path: str) -> str:
    """A name after all complete versions'; no two writers get the same."""
    complete = versions(spark, path)
    number = int(complete[-1].split("-")[0].removeprefix("v")) + 1 if complete else 1
    return f"v{number:08d}-{uuid.uuid4().hex[:8]}"


def publish_version(spark: SparkSession, path: str, version: str, keep: int = 2) -> None:
    """Make a written version the current one; of the earlier ones the last ``keep - 1`` stay, for readers under way."""
    root = path.rstrip("/")
    mark(spark, f"{root}/{MARKS}/{version}")
    for old in versions(spark, path)[:-keep]:
        delete(spark, f"{root}/{MARKS}/{old}")
        delete(spark, f"{root}/{old}")
