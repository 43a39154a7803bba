"""Token ids of a public byte-pair vocabulary with word ends, batch-wise and exact.

A text's pre-tokens (letter runs, single digits, runs of other signs, English contractions) are encoded one by one, so a
batch needs the merges of its distinct pre-tokens only. Texts of ASCII and Latin-1 letters are cut here by byte class;
any other text, and one that may hold a special token, goes through the tokenizer as a whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from heliovent.llm.text import gather, span_hashes, text_bytes

CACHED = 400_000  # distinct pre-tokens a worker keeps; it starts anew beyond that
_LETTER, _DIGIT, _OTHER = 1, 2, 3

_CLASS = np.full(256, _OTHER, np.uint8)
_CLASS[[0x20, *range(0x09, 0x0E)]] = 0
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("a") : ord("z") + 1] = _LETTER
_CLASS[ord("A") : ord("Z") + 1] = _LETTER
_CLASS[0x80:] = _LETTER
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def lower_latin(data: np.ndarray) -> np.ndarray:
    """UTF-8 with A-Z and the capitals of Latin-1 in lower case."""
    out = _LOWER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3) + 1
    lead = lead[(data[lead] >= 0x80) & (data[lead] <= 0x9E) & (data[lead] != 0x97)]
    out[lead] += 32
    return out


class Encoder:
    """Ids of texts; keeps those of pre-tokens met before."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in set(shown)]
        self.shown = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.known: dict[int, np.ndarray] = {}

    def _spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        kind = _CLASS[data]
        new = np.ones(len(data), bool)
        new[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        new[offsets[(offsets > 0) & (offsets < len(data))]] = True
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(data))
        kinds = kind[starts]
        # a lone apostrophe takes the contraction after it
        lone = np.flatnonzero((kinds[:-1] == _OTHER) & (kinds[1:] == _LETTER) & (ends[:-1] - starts[:-1] == 1) & (data[starts[:-1]] == ord("'")))
        if len(lone):
            lone = lone[~np.isin(starts[lone + 1], offsets)]
            one = data[starts[lone + 1]]
            two = data[np.minimum(starts[lone + 1] + 1, len(data) - 1)]
            pair = (ends[lone + 1] - starts[lone + 1] > 1) & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
            takes = np.isin(one, np.frombuffer(b"stmd", np.uint8)) + 2 * pair
            ends[lone] += takes
            starts[lone + 1] += takes
        keep = (kinds > 0) & (ends > starts)
        return starts[keep], ends[keep]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        raw, offsets = text_bytes(texts)
        n = len(offsets) - 1
        data = lower_latin(raw)
        # plain: ASCII and two-byte letters led by C3, without a sign that could open a special token
        after = np.zeros(len(raw), bool)
        after[1:] = raw[:-1] == 0xC3
        odd = (raw >= 0x80) & (raw != 0xC3) & ~after | after & ((raw == 0x97) | (raw == 0xB7))
        odd[:-1] |= (raw[:-1] == ord("<")) & (raw[1:] == ord("|"))
        odd = np.diff(np.r_[0, np.cumsum(odd)][offsets]) > 0
        starts, ends = self._spans(data, offsets)
        doc = np.searchsorted(offsets, starts, "right") - 1
        keep = ~odd[doc]
        starts, ends, doc = starts[keep], ends[keep], doc[keep]
        hashes, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > CACHED:
            self.known.clear()
        ids = [self.known.get(h) for h in hashes.tolist()]
        for i, h in enumerate(hashes.tolist()):
            if ids[i] is None:
                word = "".join(map(self.shown.__getitem__, data[starts[first[i]] : ends[first[i]]].tobytes()))
                ids[i] = self.known[h] = np.array([t.id for t in self.model.tokenize(word)], np.uint32)
        lengths = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint32), *ids])
        out = flat[gather(lengths[which], (np.cumsum(lengths) - lengths)[which])]
        counts = np.bincount(doc, lengths[which], minlength=n).astype(np.int64)
        if odd.any():
            at = np.flatnonzero(odd)
            got = [np.array(x.ids, np.uint32) for x in self.whole.encode_batch([raw[offsets[i] : offsets[i + 1]].tobytes().decode() for i in at], add_special_tokens=False)]
            ends = np.cumsum(counts)
            parts, was = [], 0
            for i, x in zip(at.tolist(), got):
                parts += [out[was : ends[i]], x]
                was = ends[i]
                counts[i] = len(x)
            out = np.concatenate([*parts, out[was:]])
        return out, counts


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's own, with what it has kept."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
