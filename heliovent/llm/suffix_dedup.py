"""Removal of long byte strings that an earlier document has, by suffix arrays.

A byte goes if a ``length``-byte string covers it that also starts in a document with a smaller doc_id. To keep the
suffix arrays small and many, only texts that can share a string meet:

1. Every window of ``length`` bytes has an anchor: of its runs of ``GRAM`` bytes the one with the least hash, the leftmost
   of equals. Equal windows have equal anchors. Windows in a row with one anchor make a stretch.
2. Every anchor learns (``exchange``, by key range) whether several documents have it, and a label: the place of its first
   occurrence, in units of ``UNIT`` bytes. An anchor of over ``HOT`` occurrences is its own label; of one of over ``SPREAD``, such as
   in a line that many documents have between other texts, each window is, by its hash.
3. Neighbouring stretches of one label form a piece. A block sends each distinct piece once, with the smallest doc_id that
   has it. All pieces of a label meet in one task, so equal windows always meet, and windows of a common line spread over all tasks.
4. The suffix array of a label's pieces (``suffix_array``) brings equal windows together; neighbours in it are compared
   byte by byte, and each run of equal windows takes the smallest doc_id of its pieces. Pieces go back with these ids, and
   every document removes the windows that have a smaller one.

So a label holds the surroundings of ``UNIT`` bytes at ``HOT`` places, or of one anchor at ``SPREAD``, however many documents share them,
and its suffix array some hundreds of KiB. Null texts are empty; texts below ``length`` bytes keep everything. Matches never cross documents;
rows with one doc_id do not remove each other's strings. A null doc_id counts as larger than all. An empty table gives an
empty result.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from heliovent.llm import exchange as ex
from heliovent.llm import storage
from heliovent.llm.suffix_array import suffix_array
from heliovent.llm.text import U64, column, gather, mix, powers, prefix_sums, runs, span_hashes, text_bytes

GRAM = 30
UNIT = 256
HOT = 512
SPREAD = 4096
BATCH = 1 << 14  # bytes of a suffix array, about: small enough for the cache, large enough for few calls
PIECE = 4096  # windows; a longer stretch of one label makes several pieces
NO_ID = (1 << 63) - 1
_PLACE = U64((1 << 22) - 1)
_SLICE = 1 << 17  # bytes at a time, so that temporaries stay in the cache

_PIECES = pa.schema([*ex.REQUEST_ARROW])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])


def _slices(offsets: np.ndarray, length: int):
    """Ranges of texts and of their bytes, about _SLICE bytes each; a longer text comes in overlapping parts with all its windows."""
    at = 0
    while at < len(offsets) - 1:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _SLICE, "right")) - 1)
        low, high = int(offsets[at]), int(offsets[to])
        while high - low > 2 * _SLICE:
            yield at, to, low, low + _SLICE + length - 1
            low += _SLICE
        yield at, to, low, high
        at = to


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` values in a row."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def anchors(data: np.ndarray, length: int, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Of every window of the bytes (under 4 MiB of them), the place of its anchor; and the hash of every gram."""
    sums = prefix_sums(data)
    count = len(data) - gram + 1
    grams = mix((sums[gram:] - sums[:-gram]) * powers(count, True))
    width = length - gram + 1
    return (_least((grams & ~_PLACE) | np.arange(count, dtype=U64), width) & _PLACE).astype(np.int64), grams


class _Stretches:
    """Windows in a row with one anchor, in all texts of a block, texts by doc_id: text, first and last window, key."""

    def __init__(self, table: pa.Table, length: int):
        ids = column(table, "doc_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        self.ids, self.order = ids[order], order
        self.data, self.offsets = text_bytes(column(table, "text").take(pa.array(order)))
        parts = [(np.zeros(0, np.int64),) * 4 + (np.zeros(0, U64),)]
        for a, b, base, high in _slices(self.offsets, length):
            data = self.data[base:high]
            if len(data) < length:
                continue
            place, grams = anchors(data, length)
            ends = np.minimum(self.offsets[a + 1 : b + 1], high) - base
            valid = np.ones(len(place), bool)
            for end in ends[:-1].tolist():
                valid[max(0, end - length + 1) : end] = False
            new = np.ones(len(place), bool)
            new[1:] = (place[1:] != place[:-1]) | (valid[1:] != valid[:-1])
            starts = np.flatnonzero(new)
            last = np.r_[starts[1:], len(place)] - 1
            starts, last = starts[valid[starts]], last[valid[starts]]
            parts.append((np.searchsorted(ends, starts, "right") + a, starts + base, last + base, place[starts] + base, grams[place[starts]]))
        self.docs, self.first, self.last, self.anchor, self.keys = (np.concatenate(x) for x in zip(*parts))
        self.distinct, self.codes = np.unique(self.keys, return_inverse=True)


def _key_requests(parts: int, length: int):
    def make(table: pa.Table) -> pa.Table:
        x = _Stretches(table, length)
        low, high, count = (np.zeros(len(x.distinct), np.int64) for _ in range(3))
        place = np.zeros(len(x.distinct), np.int64)
        low[x.codes[::-1]] = x.ids[x.docs[::-1]]
        high[x.codes] = x.ids[x.docs]
        place[x.codes[::-1]] = (x.anchor - x.offsets[x.docs])[::-1]
        count = np.bincount(x.codes, minlength=len(x.distinct))

        def payload(a, b):
            return ex.pack(ex.pack_ints(low[a:b]), ex.pack_ints(high[a:b] - low[a:b]), ex.pack_ints(place[a:b]), ex.pack_counts(count[a:b]))

        return ex.rows_table(ex.requests(table["block_id"][0].as_py(), 0, x.distinct, parts, payload), ex.REQUEST_ARROW)

    return make


def _label(table: pa.Table) -> pa.Table:
    asked = ex.Asked(table)
    got = [ex.unpack(x) for x in asked.payloads]
    low, high, place = (np.concatenate([ex.unpack_ints(x[i]) for x in got]).astype(np.int64) for i in range(3))
    high += low
    count = asked.total(np.concatenate([ex.unpack_counts(x[3]) for x in got]))
    first, last = asked.least(low), -asked.least(-high)
    keys = np.concatenate([ex.unpack_keys(x.as_py()) for x in table["keys"]])[asked.order][asked.starts]
    place = asked.least(np.where(low == first[asked.place], place, NO_ID))
    label = mix(mix(first.astype(U64)) + (place // UNIT).astype(U64))
    label = np.where(count > HOT, mix(keys ^ U64(0x632BE59BD9B4E019)), label)
    several, spread = first != last, count > SPREAD

    def payload(at: np.ndarray) -> bytes:
        flags = several[at]
        return ex.pack(np.packbits(flags).tobytes(), label[at][flags].tobytes(), np.packbits(spread[at][flags]).tobytes())

    return ex.rows_table(asked.answers(table["part"][0].as_py(), 0, payload), ex.ANSWER_ARROW)


class _Pieces:
    """Pieces of a block's texts: text, first and last window, label, hash of the bytes."""

    def __init__(self, x: _Stretches, answers: pa.Table, parts: int, length: int):
        at = ex.cuts(x.distinct, parts)
        flags, labels, spread = [np.zeros(0, bool)], [np.zeros(0, U64)], [np.zeros(0, bool)]
        sizes = iter((np.diff(at)[np.diff(at) > 0]).tolist())
        for payload in ex.in_order(answers, 0):
            bits, label, wide = ex.unpack(payload)
            flags.append(np.unpackbits(np.frombuffer(bits, np.uint8), count=next(sizes)).astype(bool))
            labels.append(np.frombuffer(label, U64))
            spread.append(np.unpackbits(np.frombuffer(wide, np.uint8), count=len(labels[-1])).astype(bool))
        several = np.concatenate(flags)
        label, wide = np.zeros(len(several), U64), np.zeros(len(several), bool)
        label[several], wide[several] = np.concatenate(labels), np.concatenate(spread)
        keep = several[x.codes]
        docs, first, last, label, wide = x.docs[keep], x.first[keep], x.last[keep], label[x.codes[keep]], wide[x.codes[keep]]
        new = np.ones(len(docs), bool)
        new[1:] = (docs[1:] != docs[:-1]) | (first[1:] != last[:-1] + 1) | (label[1:] != label[:-1])
        starts = np.flatnonzero(new)
        docs, label, wide, first = docs[starts], label[starts], wide[starts], first[starts]
        last = last[np.r_[starts[1:], len(new)] - 1] if len(starts) else last
        size = np.where(wide, 1, PIECE)  # windows of a piece; long stretches make several
        n = -(-(last - first + 1) // size)
        self.docs, self.label = np.repeat(docs, n), np.repeat(label, n)
        self.first = gather(n, np.zeros(len(n), np.int64)) * np.repeat(size, n) + np.repeat(first, n)
        self.last = np.minimum(self.first + np.repeat(size, n) - 1, np.repeat(last, n))
        alone = np.repeat(wide, n)
        begin = self.first[alone]
        self.label[alone] = mix(span_hashes(x.data, begin, begin + length) ^ U64(0x3C6EF372FE94F82B))
        self.hash = mix(span_hashes(x.data, self.first, self.last + length) + self.label)
        # by label and content, the smallest doc_id first; the same order whenever the block is read
        order = np.lexsort((self.docs, self.hash, self.label))
        same = np.zeros(len(order), bool)
        same[1:] = (self.hash[order][1:] == self.hash[order][:-1]) & (self.label[order][1:] == self.label[order][:-1])
        self.distinct = order[~same]
        self.which = np.empty(len(order), np.int64)
        self.which[order] = np.cumsum(~same) - 1


def _piece_requests(parts: int, length: int):
    def make(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows or not answers.num_rows:
            return ex.rows_table([], ex.REQUEST_ARROW)
        x = _Stretches(table, length)
        pieces = _Pieces(x, answers, parts, length)
        at = pieces.distinct
        first, last, docs = pieces.first[at], pieces.last[at], x.ids[pieces.docs[at]]

        def payload(a, b):
            sizes = last[a:b] + length - first[a:b]
            return ex.pack(ex.pack_ints(docs[a:b]), ex.pack_ints(sizes), x.data[gather(sizes, first[a:b])].tobytes())

        rows = ex.requests(table["block_id"][0].as_py(), 1, pieces.label[at], parts, payload)
        return ex.rows_table(rows, ex.REQUEST_ARROW)

    return make


def _equal_windows(pieces: list[bytes], length: int) -> list[np.ndarray]:
    """Groups of equal windows over all pieces, as a number for each window of each piece."""
    data = np.frombuffer(b"\0".join(pieces) + b"\0", np.uint8)
    sizes = np.array([len(p) for p in pieces])
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    symbols = data.astype(np.int64) + 1
    symbols[ends - 1] = 0
    valid = np.zeros(len(data), bool)
    valid[gather(sizes - length + 1, starts)] = True
    order = np.array(suffix_array(symbols))
    order = order[valid[order]]
    windows = np.lib.stride_tricks.sliding_window_view(data, length)
    new = np.ones(len(order), bool)
    for a in range(1, len(order), 1 << 16):
        b = min(len(order), a + (1 << 16))
        new[a:b] = (windows[order[a:b]] != windows[order[a - 1 : b - 1]]).any(axis=1)
    number = np.zeros(len(data), np.int64)
    number[order] = np.cumsum(new) - 1
    return [number[s : s + n - length + 1] for s, n in zip(starts.tolist(), sizes.tolist())]


def _least_ids(pieces: list[bytes], ids: np.ndarray, length: int) -> list[np.ndarray]:
    """Of every window of distinct pieces, the smallest doc_id of the pieces that have it."""
    number = _equal_windows(pieces, length)
    every = np.concatenate(number)
    each = np.repeat(ids, [len(x) for x in number])
    least = np.full(int(every.max()) + 1, NO_ID)
    order = np.argsort(-each, kind="stable")
    least[every[order]] = each[order]
    return [least[x] for x in number]


def _least_by_group(groups: list[tuple[list[bytes], np.ndarray]], length: int) -> list[list[np.ndarray]]:
    """_least_ids of the pieces of each group, which may be equal. Windows of different groups are never equal, so groups
    share suffix arrays of about BATCH bytes."""
    out, batch, size = [], {}, 0
    last: list[tuple[list[bytes], dict]] = []

    def finish() -> None:
        texts = list(batch)
        if texts:
            batch.update(zip(texts, _least_ids(texts, np.array([batch[t] for t in texts]), length)))
        out.extend([own[t] if t in own else batch[t] for t in pieces] for pieces, own in last)

    for pieces, ids in groups:
        best: dict[bytes, int] = {}
        for piece, i in zip(pieces, ids.tolist()):
            best[piece] = min(i, best.get(piece, NO_ID))
        if len(best) == 1:  # a piece cannot repeat what only it holds
            ((piece, i),) = best.items()
            last.append((pieces, {piece: np.full(len(piece) - length + 1, i)}))
            continue
        last.append((pieces, {}))
        batch |= best
        size += sum(map(len, best))
        if size >= BATCH:
            finish()
            last, batch, size = [], {}, 0
    finish()
    return out


def _search(length: int):
    def make(table: pa.Table) -> pa.Table:
        asked = ex.Asked(table)
        got = [ex.unpack(x) for x in asked.payloads]
        ids = np.concatenate([ex.unpack_ints(x[0]) for x in got]).astype(np.int64)
        pieces: list[bytes] = []
        for x in got:
            at = 0
            for n in ex.unpack_ints(x[1]).tolist():
                pieces.append(x[2][at : at + n])
                at += n
        found: list = [None] * len(pieces)
        bounds = [*asked.starts.tolist(), len(pieces)]
        places, groups = [], []
        for a, b in zip(bounds[:-1], bounds[1:]):  # a label
            own = asked.order[a:b]
            places.append(own.tolist())
            groups.append(([pieces[i] for i in own], ids[own]))
        for own, least in zip(places, _least_by_group(groups, length)):
            for i, x in zip(own, least):
                found[i] = x
        ends, rows, part = np.cumsum(asked.sizes).tolist(), [], table["part"][0].as_py()
        for block, n, end in zip(asked.blocks, asked.sizes.tolist(), ends):
            starts, values, counts = [], [], []
            for least in found[end - n : end]:
                at = np.flatnonzero(np.r_[True, least[1:] != least[:-1]])
                starts.append(at)
                values.append(least[at])
                counts.append(len(at))
            payload = ex.pack(ex.pack_counts(np.array(counts)), ex.pack_ints(np.concatenate(starts)), ex.pack_ints(np.concatenate(values)))
            rows.append({"part": part, "kind": 1, "block_id": block, "payload": payload})
        return ex.rows_table(rows, ex.ANSWER_ARROW)

    return make


def _remove(parts: int, length: int, schema: pa.Schema | None):
    """schema: of rows to return with their text replaced; None: what was removed."""

    def make(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return ex.rows_table([], schema or _OUT)
        x = _Stretches(table, length)
        change = np.zeros(len(x.data) + 1, np.int32)
        if answers.num_rows:
            pieces = _Pieces(x, answers, parts, length)
            got = [ex.unpack(y) for y in ex.in_order(answers, 1)]
            none = np.zeros(0, np.int64)
            counts = np.concatenate([none, *(ex.unpack_counts(y[0]) for y in got)])
            starts, values = (np.concatenate([none, *(ex.unpack_ints(y[i]).astype(np.int64) for y in got)]) for i in (1, 2))
            begin = np.cumsum(counts) - counts
            n = counts[pieces.which]
            at = gather(n, begin[pieces.which])  # every piece's runs of windows
            piece = np.repeat(np.arange(len(n)), n)
            first = pieces.first[piece] + starts[at]
            last = np.r_[first[1:] - 1, 0]
            end = np.cumsum(n) - 1
            last[end] = pieces.last
            gone = values[at] < x.ids[pieces.docs[piece]]
            np.add.at(change, first[gone], 1)
            np.add.at(change, last[gone] + length, -1)
        removed = np.cumsum(change[:-1]) > 0
        begin, _ = runs(removed, x.offsets)
        spans = np.diff(np.searchsorted(begin, x.offsets))
        total = np.r_[0, np.cumsum(removed)]
        gone = np.diff(total[x.offsets])
        kept, at = x.data[~removed].tobytes(), (x.offsets - total[x.offsets]).tolist()
        texts = [kept[a:b] for a, b in zip(at[:-1], at[1:])]
        if schema is not None:
            rest = column(table, "rest").take(pa.array(x.order))
            text = pa.array([t.decode(errors="ignore") for t in texts], pa.string())
            return pa.table([text if f.name == "text" else rest.field(f.name) for f in schema], schema=schema)
        sha = [hashlib.sha256(t).hexdigest() for t in texts]
        return pa.table([pa.array(x.ids), pa.array(np.diff(x.offsets)), pa.array(gone), pa.array(spans), pa.array(sha)], schema=_OUT)

    return make


def _removed(docs: DataFrame, length: int, schema: pa.Schema | None, ddl) -> DataFrame:
    rest = F.struct(*[c for c in docs.columns if c != "text"])
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *([rest.alias("rest")] if schema else []))
    blocks = storage.Blocks(rows, size=6 << 20)
    parts = 4 * blocks.parts
    labels = storage.stored(blocks.ask(_key_requests(parts, length), ex.REQUEST).groupBy("part").applyInArrow(_label, ex.ANSWER))
    found = blocks.with_answers(labels, _piece_requests(parts, length), ex.REQUEST).groupBy("part").applyInArrow(_search(length), ex.ANSWER)
    return blocks.with_answers(labels.union(found), _remove(parts, length, schema), ddl)


def remove_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts in a document with a smaller doc_id.

    Returns doc_id, n_bytes, n_removed, n_spans (maximal removed runs), kept_sha256 (of the bytes that stay).
    """
    out = _removed(docs, length, None, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def without_repeats(docs: DataFrame, length: int = 50) -> DataFrame:
    """The rows with what remove_repeats removes taken out of ``text``; characters cut in part go as well."""
    return _removed(docs, length, to_arrow_schema(docs.schema), docs.schema)
