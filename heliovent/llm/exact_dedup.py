"""Groups of equal texts by a content sort.

1. Every chunk of rows of an input partition sorts its normalised texts (A-Z in lower case, UTF-8 bytes) and folds equal
   ones: a chunk holds a text once, with its best row, its number of rows and their doc_ids. These sorted chunks are written.
2. Spark samples splitters over the chunks' texts, range-partitions them and sorts each range, spilling where it must. A splitter is a
   text's first ``PREFIX`` bytes and its hash, so that texts with a beginning in common spread over ranges and the driver gets
   a bounded sample (at most some three million splitters). Equal texts now are neighbours in one range; a text that a third of all rows
   hold has one entry per chunk there.
3. One pass compares neighbours byte by byte and closes a group where they differ. Each entry gets the doc_id that stays, the
   size of the group and the digest.
4. These answers join the chunks' lists of doc_ids by (chunk, place), an even key, and every row comes back.

Null texts count as empty. Rows may share a doc_id: exactly one row of a group is kept. A null doc_id gives way to all
others; a group of such rows alone keeps one of them, and keep_id is null. Texts of any length are compared whole; memory in a
task is a chunk (about ``CHUNK`` bytes of text, or one longer text) and, for one group at a time, a few numbers per chunk that holds it.
Other columns are left out (``unique_rows`` carries them along). An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from heliovent.llm.storage import stored
from heliovent.llm.text import column, slices, text_bytes

CHUNK = 16 << 20  # bytes of text
PREFIX = 32  # bytes of a text in a splitter
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_NONE = -(1 << 63)  # of a null doc_id: it gives way to all others
_SIGN = {"largest": 1, "smallest": -1}

_ENTRY = [("chunk", pa.int64()), ("place", pa.int32()), ("content", pa.binary()), ("best", pa.int64()), ("ids", pa.list_(pa.int64()))]
_ENTRY_DDL = "chunk long, place int, content binary, best long, ids array<long>"
_ANSWER = pa.schema([("chunk", pa.int64()), ("place", pa.int32()), ("keep_id", pa.int64()), ("group_size", pa.int64()), ("stays", pa.bool_()), ("text_sha256", pa.string())])
_ANSWER_DDL = "chunk long, place int, keep_id long, group_size long, stays boolean, text_sha256 string"


def _chunks(schema: pa.Schema):
    """Sorted chunks of distinct texts; ids are those of a text's rows, the largest first."""
    carried = "row" in schema.names

    def make(batches) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in _gathered(batches):
            ids = column(batch, "doc_id").to_numpy()
            data, offsets = text_bytes(column(batch, "text"))
            lower, at = data.tobytes().translate(_LOWER), offsets.tolist()
            texts = [lower[a:b] for a, b in zip(at[:-1], at[1:])]
            order = sorted(np.argsort(-ids, kind="stable").tolist(), key=texts.__getitem__)  # of equals the largest id first
            new = [i for i, k in enumerate(order) if not i or texts[k] != texts[order[i - 1]]]
            ids = ids[order]
            lists = pa.ListArray.from_arrays(pa.array([*new, len(order)], pa.int32()), pa.array(ids))
            first = [order[i] for i in new]
            arrays = [pa.array([number] * len(new)), pa.array(range(len(new)), pa.int32()), pa.array([texts[k] for k in first], pa.binary()), pa.array(ids[new]), lists]
            if carried:
                arrays.append(column(batch, "row").take(pa.array(first)))
            yield from _cut(pa.RecordBatch.from_arrays(arrays, schema=schema))
            number += 1

    return make


def _gathered(batches) -> Iterator[pa.RecordBatch]:
    """Batches of about ``CHUNK`` bytes of text, in the order in which they come."""
    held, size = [], 0
    for batch in slices(batches, most=CHUNK):
        own = int(text_bytes(column(batch, "text"))[1][-1])
        if held and size + own > CHUNK:
            yield pa.concat_batches(held)
            held, size = [], 0
        held.append(batch)
        size += own
    if held:
        yield pa.concat_batches(held)


def _cut(batch: pa.RecordBatch, rows: int = 2048) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def _neighbours(batches) -> Iterator[pa.RecordBatch]:
    """Groups of equal neighbours in a sorted range. The best entry of a group comes first."""
    text, best, chunks, places, total = None, 0, [], [], 0
    rows: list[tuple] = []

    def close() -> None:
        if text is not None:
            sha = hashlib.sha256(text).hexdigest()
            rows.extend((c, p, best, total, i == 0, sha) for i, (c, p) in enumerate(zip(chunks, places)))

    for batch in batches:
        names = ("chunk", "place", "content", "best", "n")
        for chunk, place, content, own, n in zip(*(column(batch, name).to_pylist() for name in names)):
            if content != text:
                close()
                text, best, chunks, places, total = content, own, [], [], 0
            chunks.append(chunk)
            places.append(place)
            total += n
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows) if rows else [[]] * 6, _ANSWER)], schema=_ANSWER)
        rows.clear()
    close()
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), _ANSWER)], schema=_ANSWER)


def _sorted_groups(docs: DataFrame, keep: str, carried: bool) -> tuple[DataFrame, DataFrame]:
    """The written chunks and their answers. In the sort the best doc_id is the largest: smallest ones are negated."""
    number = F.coalesce(F.col("doc_id").cast("long") * _SIGN[keep], F.lit(_NONE))
    rows = docs.select(number.alias("doc_id"), "text", *([F.struct("*").alias("row")] if carried else []))
    schema, ddl = pa.schema(_ENTRY), _ENTRY_DDL
    if carried:
        schema = schema.append(to_arrow_schema(rows.schema).field("row"))
        ddl += f", row {rows.schema['row'].dataType.simpleString()}"
    chunks = stored(rows.mapInArrow(_chunks(schema), ddl))
    entries = chunks.select("content", "best", "chunk", "place", F.size("ids").cast("long").alias("n"))
    order = [F.col("content"), F.col("best").desc(), F.col("chunk"), F.col("place")]
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # by content, told apart beyond a prefix by hash: what is sampled for splitters then does not grow with the texts
    keys = [F.substring("content", 1, PREFIX), F.xxhash64("content")]
    ranges = entries.repartitionByRange(parts, *keys).sortWithinPartitions(*order)
    return chunks, ranges.mapInArrow(_neighbours, _ANSWER_DDL)


def copies(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """One row per row of docs: doc_id, keep_id (of the row of its group of equal texts that stays), group_size, kept, text_sha256.

    ``keep`` says whether the smallest or the largest doc_id stays. The digest is that of the normalised text.
    """
    chunks, answers = _sorted_groups(docs, keep, False)
    members = chunks.select("chunk", "place", F.posexplode("ids").alias("rank", "id"))
    joined = members.join(answers, ["chunk", "place"])
    return joined.select(
        *((F.nullif(F.col(c), F.lit(_NONE)) * _SIGN[keep]).alias(name) for c, name in (("id", "doc_id"), ("keep_id", "keep_id"))),
        "group_size",
        (F.col("stays") & (F.col("rank") == 0)).alias("kept"),
        "text_sha256",
    )


def unique_rows(docs: DataFrame, keep: str = "smallest") -> DataFrame:
    """The rows of docs that ``copies`` keeps, with all their columns."""
    chunks, answers = _sorted_groups(docs, keep, True)
    return chunks.join(answers.where("stays"), ["chunk", "place"]).select("row.*")
