"""Questions about keys, asked block by block and answered for the whole corpus.

Every block sends its distinct 64-bit keys, cut by key range into parts; one task per part sees all blocks'
keys of that range and answers each block in the order of its keys. Keys are hashes, so ranges are even, and a
key costs at most one entry per block however often it occurs.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa

U64 = np.uint64
REQUEST = "part int, kind int, block_id long, keys binary, payload binary"
ANSWER = "part int, kind int, block_id long, payload binary"


def pack(*fields: bytes) -> bytes:
    return struct.pack(f"<{len(fields) + 1}q", len(fields), *map(len, fields)) + b"".join(fields)


def unpack(data: bytes) -> list[bytes]:
    (n,) = struct.unpack_from("<q", data)
    lengths = struct.unpack_from(f"<{n}q", data, 8)
    at, out = 8 * (n + 1), []
    for size in lengths:
        out.append(data[at : at + size])
        at += size
    return out


def pack_ints(x: np.ndarray) -> bytes:
    """Non-negative integers, each byte plane apart, so that leading zeros cost next to nothing."""
    x = np.ascontiguousarray(x, dtype="<u8")
    planes = max(1, -(-int(x.max()).bit_length() // 8)) if len(x) else 0
    return struct.pack("<qb", len(x), planes) + x.view(np.uint8).reshape(-1, 8)[:, :planes].T.tobytes()


def unpack_ints(data: bytes) -> np.ndarray:
    n, planes = struct.unpack_from("<qb", data)
    out = np.zeros((n, 8), np.uint8)
    out[:, :planes] = np.frombuffer(data, np.uint8, n * planes, 9).reshape(planes, n).T
    return out.view("<u8").reshape(-1)


def pack_counts(x: np.ndarray) -> bytes:
    """Counts that are mostly small: a byte each, larger ones apart."""
    return pack(np.minimum(x, 255).astype(np.uint8).tobytes(), pack_ints(x[x >= 255]))


def unpack_counts(data: bytes) -> np.ndarray:
    low, high = unpack(data)
    out = np.frombuffer(low, np.uint8).astype(np.int64)
    out[out == 255] = unpack_ints(high).astype(np.int64)
    return out


def pack_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as differences."""
    return pack_ints(np.diff(keys, prepend=U64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack_ints(data), dtype=U64)


def cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where ascending keys pass from one part to the next; parts + 1 places."""
    edges = np.array([(i << 64) // parts for i in range(1, parts)], U64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(np.int64)


def requests(block_id: int, kind: int, keys: np.ndarray, parts: int, payload) -> list[dict]:
    """A row for each part in which the block has keys; payload(from, to): what goes with those keys."""
    at = cuts(keys, parts)
    return [
        {"part": p, "kind": kind, "block_id": block_id, "keys": pack_keys(keys[a:b]), "payload": payload(a, b)}
        for p, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist()))
        if b > a
    ]


def rows_table(rows: list[dict], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=schema)


REQUEST_ARROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("block_id", pa.int64()), ("keys", pa.binary()), ("payload", pa.binary())])
ANSWER_ARROW = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("block_id", pa.int64()), ("payload", pa.binary())])


class Asked:
    """All requests of one part: distinct keys, and for every entry the place of its key."""

    def __init__(self, table: pa.Table):
        self.blocks = table["block_id"].to_pylist()
        keys = [unpack_keys(x.as_py()) for x in table["keys"]]
        self.payloads = [x.as_py() for x in table["payload"]]
        self.sizes = np.array([len(x) for x in keys])
        every = np.concatenate(keys)
        order = np.argsort(every, kind="stable")
        new = np.ones(len(every), bool)
        new[1:] = np.diff(every[order]) > 0
        self.starts = np.flatnonzero(new)
        self.order = order
        self.place = np.empty(len(every), np.int64)
        self.place[order] = np.cumsum(new) - 1

    def total(self, values: np.ndarray) -> np.ndarray:
        return np.add.reduceat(values[self.order], self.starts)

    def least(self, values: np.ndarray) -> np.ndarray:
        return np.minimum.reduceat(values[self.order], self.starts)

    def answers(self, part: int, kind: int, payload) -> list[dict]:
        """payload(places): the answer for the keys at these places."""
        ends = np.cumsum(self.sizes).tolist()
        return [
            {"part": part, "kind": kind, "block_id": b, "payload": payload(self.place[e - n : e])}
            for b, n, e in zip(self.blocks, self.sizes.tolist(), ends)
        ]


def in_order(answers: pa.Table, kind: int) -> list[bytes]:
    """A block's answers of a kind, by part: the order of its keys."""
    rows = zip(answers["kind"].to_pylist(), answers["part"].to_pylist(), answers["payload"].to_pylist())
    return [x for _, x in sorted((p, x) for k, p, x in rows if k == kind)]
