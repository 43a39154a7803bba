"""Periodic stretches of words (runs), by Lyndon arrays under both orders of the words.

1. A run of period q and at least ``least`` and 2q words has equal windows of ``least // 2`` words q apart, and such windows
   cover it. So only stretches covered by windows that a text holds more than once are searched; outside of them there is no run.
2. Phase one of the suffix sorter by Lyndon prefixes (``lyndon_array``) gives the longest Lyndon word at every place, once under an
   order of the words and once under its reverse. Every run has a root among these words under one of the two.
3. Each root is extended to both sides by the longest common extension (``Extension``) with the text one period on; those
   that reach at least two periods and ``least`` words are the runs.

Words are compared by 64-bit hashes. All of it is linear but for the extensions, which take a step for each power of two. Memory
in a task is that of one slice of texts (about 4 MiB), or of one text where that is longer: some 100 bytes a word, and 8 more for each power of two
up to the longest run. Nothing is shuffled.

Null and empty texts have no words and no runs. Repeated rows and null doc_ids are rows like any other. Other columns
are left out. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovent.llm.text import U64, Words, column, gather, gram_hashes, mix, runs, slices, text_bytes

LEAST = 12  # words of the shortest run
_ODD = U64(0x9E3779B97F4A7C15)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("runs", pa.list_(_RUN)), ("collapsed", pa.string())])
_DDL = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def lyndon_array(symbols: np.ndarray) -> list[int]:
    """Of every place the length of the longest Lyndon word that starts there.

    ``symbols`` holds strings one after another, with a 0 before each of them that is smaller than every other symbol and starts
    the sequence; places of zeros have no meaning. Suffixes are grouped by symbol, and groups are taken in descending
    order. Of each suffix of a group the nearest suffix to the left in a lower group is found by way of the suffixes
    handled before; it absorbs the Lyndon word of the one that points to it. Those pointed to leave their group for a new one
    just above, the more pointers the higher, which keeps every group's members at one Lyndon word.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    first = np.flatnonzero(np.diff(symbols[order], prepend=-1))
    groups = [part.tolist() for part in np.split(order, first[1:])]
    numbers = np.empty(n, np.int64)
    numbers[order] = np.repeat(np.arange(len(groups)), np.diff(np.r_[first, n]))
    home = numbers.tolist()
    count = [len(g) for g in groups]
    down = list(range(-1, len(groups) - 1))
    up = [*range(1, len(groups)), -1]
    word = [1] * n
    left = [-1] * n  # the pointer of a suffix handled before
    g = len(groups) - 1
    while g > 0:  # group 0 is that of the zeros
        pointers: dict[int, int] = {}
        if count[g]:
            own = groups[g] if count[g] == len(groups[g]) else [s for s in groups[g] if home[s] == g]
            own.sort()
            for s in own:
                p = s - 1
                while left[p] >= 0:
                    p = left[p]
                left[s] = p
                word[p] += word[s]
                pointers[p] = pointers.get(p, 0) + 1
        levels: dict[int, list[int]] = {}
        for p, k in pointers.items():
            if home[p]:
                levels.setdefault(k, []).append(p)
        for k in sorted(levels, reverse=True):
            moved: dict[int, int] = {}
            for p in levels[k]:
                old = home[p]
                new = moved.get(old)
                if new is None:
                    if count[old] == 1:
                        continue
                    new = moved[old] = len(groups)
                    groups.append([])
                    count.append(0)
                    above = up[old]
                    up[old] = new
                    down[above] = new  # there is one: the group at hand is above
                    up.append(above)
                    down.append(old)
                groups[new].append(p)
                count[new] += 1
                count[old] -= 1
                home[p] = new
        g = down[g]
    return word


class Extension:
    """Longest common extensions to the right, by hashes of blocks whose lengths are powers of two."""

    def __init__(self, values: np.ndarray):
        self.names = [values]

    def _equal(self, k: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        while len(self.names) <= k:
            half, size = self.names[-1], 1 << (len(self.names) - 1)
            self.names.append(mix(half[:-size] * _ODD + mix(half[size:])) if len(half) > size else half[:0])
        names = self.names[k]
        inside = np.maximum(i, j) < len(names)
        out = np.zeros(len(i), bool)
        out[inside] = names[i[inside]] == names[j[inside]]
        return out

    def __call__(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many values from i and from j on are equal."""
        length = np.zeros(len(i), np.int64)
        level = np.zeros(len(i), np.int64)
        going, k = np.arange(len(i)), 0
        while len(going):  # up, in blocks that double
            equal = self._equal(k, i[going] + length[going], j[going] + length[going])
            level[going] = k
            going = going[equal]
            length[going] += 1 << k
            k += 1
        for k in range(k - 2, -1, -1):  # and down again from the block that differed
            at = np.flatnonzero(level > k)
            equal = self._equal(k, i[at] + length[at], j[at] + length[at])
            length[at[equal]] += 1 << k
        return length


def runs_of(symbols: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of every run of at least ``least`` symbols in strings laid out as for ``lyndon_array``."""
    places = np.flatnonzero(symbols)
    reverse = np.where(symbols, symbols.max(initial=0) + 1 - symbols, 0)
    roots = [places * len(symbols) + np.array(lyndon_array(s), np.int64)[places] for s in (symbols, reverse)]
    i, period = np.divmod(np.unique(np.concatenate(roots)), max(1, len(symbols)))
    values = mix(symbols.astype(U64) * _ODD)
    zero = symbols == 0
    values[zero] = mix(np.flatnonzero(zero).astype(U64) + U64(1 << 40))  # a zero is equal to itself only
    after = Extension(values)(i, i + period)
    ends = len(symbols) - i
    before = Extension(values[::-1].copy())(ends, ends - period)
    start, end = i - before, i + period + after
    keep = np.flatnonzero(end - start >= np.maximum(least, 2 * period))
    keep = keep[np.lexsort((period[keep], start[keep]))]
    start, end, period = start[keep], end[keep], period[keep]
    new = np.ones(len(keep), bool)
    new[1:] = (start[1:] != start[:-1]) | (period[1:] != period[:-1])
    return start[new], end[new], period[new]


def planted_period(doc_id: int | None, n: int) -> tuple[int, int] | None:
    """From which word on, and with which period, a text of n words is repeated; None: it stays as it is."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    return g % n, 1 + (n - g % n) // (3 + g % 8)


def _search(least: int, plant: Callable | None):
    def make(batches):
        for batch in slices(batches):
            ids = column(batch, "doc_id")
            data, offsets = text_bytes(column(batch, "text"))
            words = Words(data, offsets)
            first = words.first
            source = np.arange(len(words.starts))
            changed = {}
            if plant:
                for d, (i, a, b) in enumerate(zip(ids.to_pylist(), first[:-1].tolist(), first[1:].tolist())):
                    if found := plant(i, b - a):
                        at, period = found
                        source[a + at : b] = a + at + np.arange(b - a - at) % period
                        changed[d] = True
            start, end, period = _runs_of_words(words.hashes(lower=False)[source], first, least)
            doc = np.searchsorted(first, start, "right") - 1
            gone = np.zeros(len(source) + 1, np.int64)
            np.add.at(gone, start + period, 1)
            np.add.at(gone, end, -1)
            kept = np.cumsum(gone[:-1]) == 0
            changed.update(dict.fromkeys(doc.tolist(), True))
            raw, cuts, texts = data.tobytes(), offsets.tolist(), []
            for d, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
                text = raw[a:b].split()
                if d in changed:
                    low, high = first[d], first[d + 1]
                    text = [text[w] for w in (source[low:high] - low)[kept[low:high]].tolist()]
                texts.append(b" ".join(text))
            flat = pa.StructArray.from_arrays([pa.array(x) for x in (start - first[doc], end - start, period)], fields=list(_RUN))
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(ids) + 1)).astype(np.int32)), flat)
            yield pa.RecordBatch.from_arrays([ids, lists, pa.array(texts, pa.binary()).cast(pa.string())], schema=_OUT)

    return make


def _runs_of_words(hashes: np.ndarray, first: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """runs_of all texts of a batch, ascending by start; first: of each text's words, n + 1 values."""
    width = least // 2
    none = np.zeros(0, np.int64)
    if len(hashes) < least:
        return none, none, none
    docs = np.repeat(np.arange(len(first) - 1), np.diff(first))
    windows = gram_hashes(hashes, width)
    count = len(windows)
    inside = np.flatnonzero(docs[:count] == docs[width - 1 :])
    keys = mix(windows[inside] + docs[inside].astype(U64) * _ODD)
    order = np.argsort(keys)
    same = keys[order][1:] == keys[order][:-1]
    again = inside[np.unique(np.concatenate([order[1:][same], order[:-1][same]]))]
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + width, -1)
    low, high = runs(np.cumsum(edge[:-1]) > 0, first)
    size = high - low
    if not len(size):
        return none, none, none
    at = np.cumsum(size + 1) - size  # a zero stands before each stretch
    symbols = np.zeros(int(size.sum()) + len(size), np.int64)
    symbols[gather(size, at)] = np.unique(hashes[gather(size, low)], return_inverse=True)[1] + 1
    start, end, period = runs_of(symbols, least)
    moved = (low - at)[np.searchsorted(at, start, "right") - 1]
    return start + moved, end + moved, period


def find_runs(docs: DataFrame, least: int = LEAST, plant: Callable[[int | None, int], tuple[int, int] | None] | None = None) -> DataFrame:
    """Runs of every text's words, and the text without their repetitions.

    A run is a stretch of words with smallest period q, at least ``least`` and 2q long, that no neighbouring word extends. Returns doc_id,
    runs (start, length and period in words, by start, then period) and collapsed: the words that no run holds after
    its first period, joined by a space. ``plant`` may make a text periodic before it is searched, for trials.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_search(least, plant), _DDL)


def run_digests(found: DataFrame) -> DataFrame:
    """Of find_runs: the number of runs, the longest one (then the first, then that of least period), and digests."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, period = F.col("best.length"), -F.col("best.period")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
