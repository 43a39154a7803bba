"""Numpy views of text columns: words, lines, hashes. All work on the UTF-8 bytes of a whole batch at once.

Hashes are 64-bit: 256 random values per byte, weighted by powers of an odd number, then mixed. Two different
strings agree with a probability of about 2**-62, so counts keyed by hash are exact but for that chance.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(_ODD, -1, 1 << 64)
_WINDOW = 1 << 18  # bytes hashed at a time, so that temporaries stay small

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (the finaliser of SplitMix64)."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U64) * U64(_ODD))
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_powers = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """The first n powers of the odd number (or of its inverse) modulo 2**64."""
    have = _powers[inverse]
    if len(have) < n:
        have = np.empty(max(n, _WINDOW + (_WINDOW >> 2)), U64)
        have[0] = 1
        have[1:] = U64(_INVERSE if inverse else _ODD)
        np.multiply.accumulate(have, out=have)
        if n <= 1 << 23:
            _powers[inverse] = have
    return have[:n]


def column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    got = batch.column(batch.schema.get_field_index(name))
    return got.combine_chunks() if isinstance(got, pa.ChunkedArray) else got


def text_bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and the n + 1 offsets between them; a null is an empty text."""
    if isinstance(values, pa.ChunkedArray):
        values = values.combine_chunks()
    values = values.cast(pa.large_string()).fill_null("")
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = values.buffers()
    offsets = np.frombuffer(offsets, np.int64)[values.offset : values.offset + len(values) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches, name: str = "text", most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``most`` bytes of text; a longer text stands alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(column(batch, name))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def runs(flag: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of set bytes; runs do not cross the offsets."""
    if not len(flag):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first, last = flag.copy(), flag.copy()
    first[1:] &= ~flag[:-1]
    last[:-1] &= ~flag[1:]
    inner = offsets[(offsets > 0) & (offsets < len(flag))]
    first[inner] = flag[inner]
    last[inner - 1] = flag[inner - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


class Words:
    """Words (runs of bytes that are no ASCII white space) of a batch of texts."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets = data, offsets
        self.starts, self.ends = runs(NOT_SPACE[data], offsets)
        self.first = np.searchsorted(self.starts, offsets)  # of each text's words; n + 1 values

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def docs(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.offsets) - 1), self.counts())

    def hashes(self, lower: bool = True) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, lower)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A hash of each span of bytes; starts ascend. With lower, A-Z count as a-z."""
    out = np.empty(len(starts), U64)
    table = _BYTE_LOWER if lower else _BYTE
    at = 0
    while at < len(starts):
        base = int(starts[at])
        to = int(np.searchsorted(starts, base + _WINDOW))
        s, e = starts[at:to] - base, ends[at:to] - base
        sums = prefix_sums(data[base : base + int(e.max())], table)
        out[at:to] = (sums[e] - sums[s]) * powers(int(s[-1]) + 1, True)[s] + (e - s).astype(U64) * U64(_INVERSE)
        at = to
    return mix(out)


def prefix_sums(data: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    sums = np.zeros(len(data) + 1, U64)
    np.multiply(table[data], powers(len(data)), out=sums[1:])
    np.cumsum(sums[1:], out=sums[1:])
    return sums


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive items; one fewer than n items give none."""
    count = max(0, len(words) - n + 1)
    out = np.zeros(count, U64)
    for i in range(n):
        out += words[i : i + count] * U64(pow(_ODD, 2 * i + 1, 1 << 64))
    return mix(out)


def gather(lengths: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Indices begins[i] .. begins[i] + lengths[i] - 1 for all i in a row."""
    total = int(lengths.sum())
    out = np.ones(total, np.int64)
    keep = lengths > 0
    lengths, begins = lengths[keep], begins[keep]
    if total:
        out[0] = begins[0]
        at = np.cumsum(lengths)[:-1]
        out[at] = begins[1:] - begins[:-1] - lengths[:-1] + 1
    return np.cumsum(out)
