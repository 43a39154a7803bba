"""Packing of tokenized documents into sequences of a fixed capacity.

A document is its token ids and an end; only longer ones are cut, into pieces of the capacity. How many pieces there are of
each length is a table of at most ``capacity`` rows, and the packing is planned on it, so planning costs the same for any
corpus: pieces above a third of the capacity share a sequence with at most one other of their kind and are matched
greedily, the longest first, each with the longest that still fits; the others fill, longest first, the smallest gap
that takes them (best fit), and open a sequence where none does. The plan says for each length which ranks go to which
sequences at which offset. A piece's rank among those of its length is its rank in the task that made it plus the
count of the tasks before.

A task holds a few MiB of texts and their ids at a time; a longer text stands alone, at about ten times its size. Null or empty
texts are the end alone. Repeated rows are packed each; a null doc_id stays null. An empty table gives an
empty result. All ties are between pieces of equal length, which may stand for each other.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from heliovent.llm.storage import stored
from heliovent.llm.text import column, slices
from heliovent.llm.tokens import encoder

END = 0
_PIECE = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("task", pa.int32()), ("rank", pa.int64())])
_PIECE_DDL = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, rank long"


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _cut(path: str, capacity: int):
    def make(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode = encoder(path)
        seen = np.zeros(capacity + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in slices(batches):
            ids, counts = encode(column(batch, "text"))
            sizes = counts + 1
            ids = np.insert(ids, np.cumsum(counts), END).astype("<u4")
            pieces = -(-sizes // capacity)
            doc = np.repeat(np.arange(len(sizes)), pieces)
            piece = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * capacity
            length = np.minimum(capacity, sizes[doc] - start)
            begin = (np.cumsum(sizes) - sizes)[doc] + start
            crc = [zlib.crc32(ids[a:b]) for a, b in zip(begin.tolist(), (begin + length).tolist())]
            order = np.argsort(length, kind="stable")
            new = np.flatnonzero(np.r_[True, np.diff(length[order]) > 0])
            rank = np.empty(len(length), np.int64)
            rank[order] = np.arange(len(length)) - np.repeat(new, np.diff(np.r_[new, len(length)]))
            rank += seen[length]
            seen += np.bincount(length, minlength=capacity + 1)
            ids_ = column(batch, "doc_id").take(pa.array(doc))
            yield pa.RecordBatch.from_arrays([ids_, pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64()), pa.array(np.full(len(doc), task), pa.int32()), pa.array(rank)], schema=_PIECE)

    return make


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, how many, first sequence, offset); pieces of a run go to sequences one after the other."""
    left = {k: n for k, n in counts.items() if n}
    rank = dict.fromkeys(left, 0)
    out: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # free room -> runs of sequences (first, how many)
    sizes: list[int] = []  # rooms that occur, ascending
    opened = 0

    def put(length: int, n: int, first: int, offset: int) -> None:
        out.append((length, rank[length], n, first, offset))
        rank[length] += n
        left[length] -= n

    def free(room: int, first: int, n: int) -> None:
        if room and n:
            if room not in gaps:
                gaps[room] = []
                insort(sizes, room)
            gaps[room].append((first, n))

    large = sorted(x for x in left if 3 * x > capacity)
    while large:
        a = large[-1]
        if not left[a]:
            large.pop()
            continue
        at = bisect_left(large, capacity - a + 1) - 1
        while at >= 0 and (left[large[at]] < (2 if large[at] == a else 1)):
            at -= 1
        if at >= 0:
            b = large[at]
            n = left[a] // 2 if a == b else min(left[a], left[b])
            put(a, n, opened, 0)
            put(b, n, opened, a)
        else:
            b, n = 0, left[a]
            put(a, n, opened, 0)
        free(capacity - a - b, opened, n)
        opened += n
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while left[length]:
            at = bisect_left(sizes, length)
            if at < len(sizes):
                room = sizes[at]
                first, n = gaps[room].pop()
                take = min(n, left[length])
                if take < n:
                    gaps[room].append((first + take, n - take))
                if not gaps[room]:
                    del gaps[room], sizes[at]
                put(length, take, first, capacity - room)
                free(room - length, first, take)
                continue
            most = capacity // length
            n = max(1, left[length] // most)
            layers = min(most, left[length])
            for k in range(layers):
                put(length, n, opened, k * length)
            free(capacity - layers * length, opened, n)
            opened += n
    return out


def _place(runs: list[tuple[int, int, int, int, int]]):
    table = np.array(sorted(runs), np.int64).reshape(-1, 5)
    keys = (table[:, 0] << 48) + table[:, 1]

    def make(batches):
        for batch in batches:
            length, rank = column(batch, "length").to_numpy(), column(batch, "rank").to_numpy()
            run = table[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([*(column(batch, x) for x in names), pa.array(run[:, 3] + rank - run[:, 1]), pa.array(run[:, 4])], names=[*names, "sequence_id", "offset"])

    return make


def pack_documents(docs: DataFrame, capacity: int = 2048, path: str | None = None) -> DataFrame:
    """Pack token ids (vocabulary file ``path``) of all documents into sequences of at most ``capacity``.

    Returns a row per piece: doc_id, piece (from 0), start (ids of the document before it), length, ids_crc32 (of
    little-endian unsigned 32-bit ids), sequence_id, offset (its place there, without gaps from 0).
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    pieces = stored(texts.mapInArrow(_cut(path or vocabulary(), capacity), _PIECE_DDL))
    counts = pieces.groupBy("task", "length").agg((F.max("rank") + 1).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = stored(counts.select("task", "length", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before")))
    lengths = {x["length"]: x["n"] for x in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most capacity rows
    # as many counts as tasks times lengths: sorted and merged with the pieces, each task's own to each, never sent to all
    own = counts.select("task", "length", "before").hint("merge")
    ranked = pieces.join(own, ["task", "length"]).withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank")
    return placed.mapInArrow(_place(plan(lengths, capacity)), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
