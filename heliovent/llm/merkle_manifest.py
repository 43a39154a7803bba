"""Merkle manifest of a table: a digest per row, trees of them per group, one tree over the groups, and proofs of every row.

A tree is cut into aligned subtrees of ``HEIGHT`` levels below their roots (blocks), each one row of a written table. Its nodes lie in
van Emde Boas order: a tree of k levels is its top half of k // 2 levels, then the bottom trees from left to right, each laid out
the same way. Where a node lies follows from its depth and index alone (``address``), for building as well as for looking up siblings, so
a path touches few stretches of a block whatever the size of a cache line. Roots of blocks are the leaves of the next
level's blocks, until a tree has a single one. Proofs go the other way: each block adds the steps inside it to those that its root inherits.

Rows are ranked in their group by a range sort: Spark samples splitters, sorts the ranges, and each range's place in its group follows from the
counts of the ranges before, of which there are as many as tasks. A group with a third of all rows is many ranges and many blocks.
What is sorted is digests and doc_ids, never texts. A task holds a block at a time (4,096 leaves); the driver gets one count a level.

A null in a row is ``-``, other values are their length in bytes, ``:``, and their text. Nodes pair up from the left, and a last one
without a partner becomes the digest of its own, as long as its level has several. Null doc_ids come first, rows with one
doc_id follow their digests, the null group comes first, other groups by their bytes. Texts may be of any length.
Other columns are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heliovent.llm.storage import stored
from heliovent.llm.text import column

HEIGHT = 12
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")

_STEP = pa.struct([("left", pa.bool_()), ("digest", pa.string())])
_STEP_DDL = "array<struct<left:boolean,digest:string>>"
_BLOCK = pa.schema([("tree", pa.string()), ("n", pa.int64()), ("block", pa.int64()), ("root", pa.string()), ("nodes", pa.binary()), ("ids", pa.list_(pa.int64())), ("notes", pa.list_(pa.string()))])
_BLOCK_DDL = "tree string, n long, block long, root string, nodes binary, ids array<long>, notes array<string>"
_PROOF = pa.schema([("tree", pa.string()), ("position", pa.int64()), ("id", pa.int64()), ("note", pa.string()), ("digest", pa.string()), ("steps", pa.list_(_STEP)), ("subroot", pa.string()), ("top", pa.string())])
_PROOF_DDL = f"tree string, position long, id long, note string, digest string, steps {_STEP_DDL}, subroot string, top string"
_HEX = np.frombuffer(b"".join(b"%02x" % i for i in range(256)), np.uint8).reshape(256, 2)


@functools.cache
def _splits(levels: int) -> list[tuple[int, int, int]]:
    """Of each depth: the depth of the root above which it was cut off, the size of that top tree, and of a bottom tree."""
    table = [(0, 0, 0)] * levels

    def split(depth: int, levels: int) -> None:
        if levels > 1:
            top = levels // 2
            table[depth + top] = (depth, (1 << top) - 1, (1 << levels - top) - 1)
            split(depth, top)
            split(depth + top, levels - top)

    split(0, levels)
    return table


def address(levels: int, depth: int, index: np.ndarray) -> np.ndarray:
    """Where the nodes with these indices at a depth lie in a tree of that many levels."""
    if not depth:
        return index
    above, top, bottom = _splits(levels)[depth]
    return address(levels, above, index >> (depth - above)) + top + (index & top) * bottom


def tree_height(n: int) -> int:
    return (n - 1).bit_length()


def _count(n: int, height: int, depth: int) -> int:
    """Nodes at a depth of a block of n leaves."""
    return -(-n >> (height - depth))


def build_block(leaves: list[str], height: int) -> np.ndarray:
    """All nodes of a block of that many levels above its leaves, 32 bytes each, by address."""
    nodes = np.zeros(((2 << height) - 1, 32), np.uint8)
    level = [x.encode() for x in leaves]
    for depth in range(height, -1, -1):
        nodes[address(height + 1, depth, np.arange(len(level)))] = np.frombuffer(bytes.fromhex(b"".join(level).decode()), np.uint8).reshape(-1, 32)
        level = [hashlib.sha256(b"".join(level[i : i + 2])).hexdigest().encode() for i in range(0, len(level), 2)]
    return nodes


def siblings(nodes: np.ndarray, n: int, height: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each of n leaves and each level upwards: whether the sibling is to the left, whether there is one, and its digest."""
    left, there = (np.zeros((n, height), bool) for _ in range(2))
    digest = np.zeros((n, height, 32), np.uint8)
    for step in range(height):
        depth = height - step
        index = np.arange(n) >> step
        left[:, step] = index & 1
        there[:, step] = (index ^ 1) < _count(n, height, depth)
        digest[:, step] = nodes[address(height + 1, depth, index ^ 1)]
    return left, there, digest


def _text(digests: np.ndarray, there: np.ndarray | None = None) -> pa.Array:
    """Digests as hex texts, null where there is none."""
    data = _HEX[digests.reshape(-1, 32)].tobytes()
    count = len(data) // 64
    bits = None if there is None else pa.py_buffer(np.packbits(there.reshape(-1), bitorder="little").tobytes())
    return pa.Array.from_buffers(pa.string(), count, [bits, pa.py_buffer(np.arange(0, 64 * count + 1, 64, np.int32).tobytes()), pa.py_buffer(data)])


def _height(n: int, height: int) -> int:
    """Levels above the leaves in a block of a tree of n leaves: only a sole block may be lower."""
    return min(height, tree_height(n))


def _build(height: int):
    def make(table: pa.Table) -> pa.Table:
        table = table.sort_by("position")
        n = table["n"][0].as_py()
        nodes = build_block(table["digest"].to_pylist(), _height(n, height))
        root = nodes[0].tobytes().hex()
        return pa.Table.from_pylist([{
            "tree": table["tree"][0].as_py(), "n": n, "block": table["position"][0].as_py() >> height, "root": root, "nodes": nodes.tobytes(),
            "ids": table["id"].to_pylist(), "notes": table["note"].to_pylist(),
        }], schema=_BLOCK)

    return make


def _expand(height: int):
    """Blocks with the steps of their roots -> leaves with theirs."""

    def make(batches):
        for batch in batches:
            for row in batch.to_pylist():
                count, levels = len(row["ids"]), _height(row["n"], height)
                nodes = np.frombuffer(row["nodes"], np.uint8).reshape(-1, 32)
                left, there, digest = siblings(nodes, count, levels)
                above = row["steps"]
                steps = levels + len(above)
                left = np.hstack([left, np.tile(np.array([s["left"] for s in above], bool), (count, 1))])
                there = np.hstack([there, np.tile(np.array([s["digest"] is not None for s in above], bool), (count, 1))])
                more = np.frombuffer(bytes.fromhex("".join(s["digest"] or "0" * 64 for s in above)), np.uint8).reshape(1, -1, 32)
                digest = np.concatenate([digest, np.repeat(more, count, axis=0)], axis=1)
                flat = pa.StructArray.from_arrays([pa.array(left.reshape(-1)), _text(digest, there)], fields=list(_STEP))
                lists = pa.ListArray.from_arrays(pa.array(np.arange(count + 1) * steps, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["tree"]] * count), pa.array((row["block"] << height) + np.arange(count)), pa.array(row["ids"], pa.int64()), pa.array(row["notes"], pa.string()),
                    _text(nodes[address(levels + 1, levels, np.arange(count))]), lists, pa.array([row["subroot"]] * count, pa.string()), pa.array([row["top"]] * count, pa.string()),
                ], schema=_PROOF)

    return make


def _ranked(rows: DataFrame, *order) -> DataFrame:
    """Rows with their position in their tree and the tree's number of rows n; equal ones spread over ranges as well."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    serial = rows.withColumn("serial", F.monotonically_increasing_id())
    keys = ["tree", *order, "serial"]
    ranges = serial.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).drop("serial")
    written = stored(ranges.withColumn("place", F.monotonically_increasing_id())).withColumn("part", F.shiftright("place", 33))
    per_part = written.groupBy("tree", "part").agg(F.min("place").alias("first"), F.count("*").alias("rows"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("rows").over(tree.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = per_part.select("tree", "part", (before - F.col("first")).alias("offset"), F.sum("rows").over(tree).alias("n"))
    return written.join(offsets, ["tree", "part"]).withColumn("position", F.col("place") + F.col("offset")).drop("place", "part", "offset")


@dataclass(frozen=True)
class Forest:
    """Blocks of trees by level, the leaves' first; ``tops``: tree and root of each."""

    levels: list[DataFrame]
    tops: DataFrame
    height: int

    def proofs(self, above: DataFrame) -> DataFrame:
        """Leaves with their steps up to their tree's root and on as ``above`` says: tree, steps, subroot, top."""
        found = None
        for blocks in reversed(self.levels):
            sole = F.col("n") <= 1 << self.height
            joined = blocks.where(sole).join(above, "tree")
            if found is not None:
                inherited = found.select("tree", F.col("position").alias("block"), "steps", "subroot", "top")
                joined = joined.unionByName(blocks.where(~sole).join(inherited, ["tree", "block"]))
            found = joined.mapInArrow(_expand(self.height), _PROOF_DDL)
        return found


def grow(leaves: DataFrame, height: int) -> Forest:
    """leaves: tree, n, position, digest, id, note -> all blocks, written level by level."""
    levels, finished = [], []
    while True:
        keyed = leaves.withColumn("block", F.shiftright("position", height))
        blocks = stored(keyed.groupBy("tree", "block").applyInArrow(_build(height), _BLOCK_DDL))
        levels.append(blocks)
        sole = F.col("n") <= 1 << height
        finished.append(blocks.where(sole).select("tree", "root"))
        if (blocks.agg(F.max("n")).first()[0] or 0) <= 1 << height:
            return Forest(levels, functools.reduce(DataFrame.unionByName, finished), height)
        no_id, no_note = F.lit(None).cast("long").alias("id"), F.lit(None).cast("string").alias("note")
        leaves = blocks.where(~sole).select("tree", F.ceil(F.col("n") / (1 << height)).alias("n"), F.col("block").alias("position"), F.col("root").alias("digest"), no_id, no_note)


def encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, values)).cast("binary"), 256)


def fold(digest: Column, steps: Column) -> Column:
    """The root that a digest and its steps lead to."""

    def up(node: Column, step: Column) -> Column:
        other = F.coalesce(step["digest"], F.lit(""))
        return F.sha2(F.when(step["left"], F.concat(other, node)).otherwise(F.concat(node, other)).cast("binary"), 256)

    return F.aggregate(steps, digest, up)


def prove(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group: str = "lang", changed: dict[str, Column] | None = None, height: int = HEIGHT) -> DataFrame:
    """doc_id, leaf, subroot (of its group), top (of all), steps (sibling's side and digest by level, null where there is none) of each row.

    ``changed`` may give other values of fields, for trials; ``presented`` then is the digest with them, else the leaf.
    """
    values = {name: F.col(name) for name in fields}
    tree = F.coalesce(F.concat(F.lit("="), F.col(group)), F.lit(""))
    presented = leaf_digest(list({**values, **(changed or {})}.values()))
    leaf = leaf_digest(list(values.values()))
    rows = docs.select(tree.alias("tree"), F.col("doc_id").cast("long").alias("id"), leaf.alias("digest"), presented.alias("note"))
    rows = stored(rows.withColumn("note", F.nullif("note", "digest")))  # the texts are read for this only
    groups = grow(_ranked(rows, "id", "digest"), height)
    of_all = groups.tops.select(F.lit("").alias("tree"), F.col("root").alias("digest"), F.lit(None).cast("long").alias("id"), F.col("tree").alias("note"))
    whole = grow(_ranked(of_all, "note"), height)
    start = whole.tops.select("tree", F.array().cast(_STEP_DDL).alias("steps"), F.lit(None).cast("string").alias("subroot"), F.col("root").alias("top"))
    above = whole.proofs(start).select(F.col("note").alias("tree"), "steps", F.col("digest").alias("subroot"), "top")
    found = groups.proofs(above)
    return found.select(F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), F.coalesce("note", "digest").alias("presented"), "subroot", F.col("top").alias("root"), "steps")


def verify(docs: DataFrame, height: int = HEIGHT) -> DataFrame:
    """Proofs of all rows, of which about a seventh are presented with n_chars raised by one; those must not verify."""
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    raised = F.when(picked, F.col("n_chars").cast("decimal(20,0)") + 1).otherwise(F.col("n_chars").cast("decimal(20,0)"))
    found = prove(docs, changed={"n_chars": raised}, height=height)
    folded = found.withColumn("folded_root", fold(F.col("presented"), F.col("steps")))
    proof = F.sha2(F.array_join(F.transform("steps", lambda s: s["digest"]), "").cast("binary"), 256)
    return folded.select("doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
