"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import contextvars
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from heliovent.llm.text import column, slices, text_bytes

BLOCK_BYTES = 12 << 20  # of text in a block, at most
BLOCK_ROWS = 1 << 16  # at most, for texts that are empty
RANGE_BYTES = 16 << 20  # of text for each key range
FIRST_BYTES = 64 << 30  # up to here they stay so; then they grow with the square root of the input,
MOST_GROWTH = 10.0  # up to this factor


def shared_dir(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; only a local session that has none gets a folder of its own."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return _own_folder()


@functools.cache
def _own_folder() -> str:
    """Removed when the program ends."""
    path = tempfile.mkdtemp(prefix="llm-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


class Scratch:
    """Folders and tables made while it is open, for their owner to drop once nothing reads them any more.

    An operator's result is read from its tables, so they must outlast the writing of it: open one around the operator, store
    the result, then drop.
    """

    _open: contextvars.ContextVar = contextvars.ContextVar("scratch", default=None)

    def __init__(self):
        self.paths: list[str] = []
        self.tables: list[str] = []

    def __enter__(self) -> Scratch:
        self._before = self._open.set(self)
        return self

    def __exit__(self, *_) -> None:
        self._open.reset(self._before)

    @classmethod
    def owner(cls) -> Scratch:
        """The one that is open, or one that nobody asks to drop anything."""
        return cls._open.get() or cls()

    def drop(self, spark: SparkSession) -> None:
        for table in self.tables:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        for path in self.paths:
            delete(spark, path)
        self.tables, self.paths = [], []


def delete(spark: SparkSession, path: str) -> None:
    """A folder of whatever file system its name says; none there is no fault."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def new_path(spark: SparkSession) -> str:
    path = f"{shared_dir(spark)}/llm-{uuid.uuid4().hex}"
    Scratch.owner().paths.append(path)
    return path


def stored(frame: DataFrame) -> DataFrame:
    """The same rows, written once and read back: cuts lineage, survives lost executors."""
    path = new_path(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def clean_text(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id, text (null: empty) and the named columns; other columns are left out."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


def _numbered(name: str, size: int, schema: pa.Schema):
    """The rows with the number of their block, which closes before it would exceed ``size`` bytes of text or ``BLOCK_ROWS`` rows."""

    def make(batches) -> Iterator[pa.RecordBatch]:
        block, held, rows = TaskContext.get().partitionId() << 33, 0, 0
        for batch in slices(batches, name, size):
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                bytes_ = np.cumsum(np.diff(text_bytes(column(part, name))[1]))
                fits = int(np.searchsorted(bytes_, size - held, "right"))  # a slice holds no more than one block can
                fits = min(fits, BLOCK_ROWS - rows)
                if fits < part.num_rows and rows:
                    numbers = block + (np.arange(part.num_rows) >= fits)
                    block, rows = block + 1, part.num_rows - fits
                    held = int(bytes_[-1] - (bytes_[fits - 1] if fits else 0))
                else:
                    numbers, rows, held = np.full(part.num_rows, block), rows + part.num_rows, held + int(bytes_[-1])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(numbers)], schema=schema)

    return make


class Blocks:
    """Rows with a text, dealt into blocks of bounded size and kept bucketed by block.

    A block is a run of rows of one input partition, so writing needs no shuffle; a longer text is a block of its own. What
    is computed for a block's keys elsewhere comes back by ``block_id``, and only that side is shuffled.
    """

    def __init__(self, frame: DataFrame, name: str = "text", size: int = BLOCK_BYTES):
        spark = frame.sparkSession
        total = frame.agg(F.count("*").alias("n"), F.sum(F.octet_length(name)).alias("b")).first()
        self.rows, self.bytes = total["n"], total["b"] or 0
        # Larger inputs take larger blocks and key ranges, so that a block still has many keys in a range.
        growth = min(MOST_GROWTH, max(1.0, (self.bytes / FIRST_BYTES) ** 0.5))
        size = int(size * growth)
        self.buckets = max(1, min(1 << 16, -(-self.bytes // size)))
        # ranges of the key space: about two million keys each at first, should every eighth byte start one
        self.parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-self.bytes // int(RANGE_BYTES * growth)))
        self.name, self.path = f"llm_blocks_{uuid.uuid4().hex}", new_path(spark)
        Scratch.owner().tables.append(self.name)
        numbered = T.StructType([*frame.schema, T.StructField("block_id", T.LongType())])
        (
            frame.mapInArrow(_numbered(name, size, to_arrow_schema(numbered)), numbered)
            .write.format("parquet").option("path", self.path).option("compression", "zstd")
            .bucketBy(self.buckets, "block_id").saveAsTable(self.name)
        )
        self.table = spark.table(self.name)

    def drop(self) -> None:
        """To be called once all that is computed from the blocks is stored."""
        spark = self.table.sparkSession
        spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        delete(spark, self.path)

    def ask(self, make, schema: str) -> DataFrame:
        """One call of make(block's rows as an Arrow table) per block."""
        return self.table.groupBy("block_id").applyInArrow(make, schema)

    def with_answers(self, answers: DataFrame, make, schema: str, rows=None) -> DataFrame:
        """One call of make(block's rows, block's answers) per block; rows: a filter on the rows."""
        table = self.table if rows is None else self.table.where(rows)
        return table.groupBy("block_id").cogroup(answers.groupBy("block_id")).applyInArrow(make, schema)
