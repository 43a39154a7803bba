"""Quality rules as a short-circuit cascade.

A rule rejects texts by features of theirs. Its cost and its rejections are estimated on a sample of ``SAMPLE`` rows at most
(those of the least hashes, none over ``SAMPLE_BYTES``) as they will be paid: the five counts that every row returns are given,
and so are features that rules chosen before have computed. The rule with the most rejections per second comes first, the next is
chosen on what it leaves, and so on. Each rule then runs on the texts that passed the ones before, and what it needs beyond the five
counts (capitals, letters, lines, distinct words) is computed only for those. The order changes the cost, never the verdict: a text is
kept if no rule rejects it.

Words are runs of bytes that are no ASCII white space. Null text: no words (rejected). A null doc_id is in no sample.
Repeated rows are judged each. An empty table gives an empty result.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovent.llm.sampling import least_hashes
from heliovent.llm.text import NOT_SPACE, Words, column, gram_hashes, runs, slices, span_hashes, text_bytes

SAMPLE, SAMPLE_BYTES = 1000, 1 << 20
WINDOW = 5


def _flags(values: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(values.encode())] = True
    return out


_SYMBOL = _flags("#*$%&|<>")
_CAPITAL = _flags("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _flags("abcdefghijklmnopqrstuvwxyz") | _CAPITAL | (np.arange(256) >= 0xC0)
_WORD_CHAR = NOT_SPACE & ((np.arange(256) & 0xC0) != 0x80)  # the first byte of each character


class Texts:
    """Texts and the features computed of them so far."""

    def __init__(self, values: pa.Array, known: dict[str, np.ndarray] | None = None):
        self.values, self.known = values, known or {}
        self._bytes = self._words = None

    def __len__(self) -> int:
        return len(self.values)

    @property
    def bytes(self) -> tuple[np.ndarray, np.ndarray]:
        if self._bytes is None:
            self._bytes = text_bytes(self.values)
        return self._bytes

    @property
    def words(self) -> Words:
        if self._words is None:
            self._words = Words(*self.bytes)
        return self._words

    def __getitem__(self, feature: str) -> np.ndarray:
        if feature not in self.known:
            self.known[feature] = FEATURES[feature](self)
        return self.known[feature]

    def again(self) -> Texts:
        """The same with what is known so far, to compute more aside."""
        out = Texts(self.values, dict(self.known))
        out._bytes, out._words = self._bytes, self._words
        return out

    def where(self, keep: np.ndarray) -> Texts:
        return self if keep.all() else Texts(self.values.filter(pa.array(keep)), {k: v[keep] for k, v in self.known.items()})

    def count(self, table: np.ndarray) -> np.ndarray:
        """Bytes of each text that the table marks."""
        data, offsets = self.bytes
        return np.diff(np.r_[0, np.cumsum(table[data])][offsets])


def _dup_lines(texts: Texts) -> np.ndarray:
    data, offsets = texts.bytes
    starts, ends = runs(data != 10, offsets)
    total = np.r_[0, np.cumsum(NOT_SPACE[data])]
    keep = total[ends] > total[starts]
    starts, ends = starts[keep], ends[keep]
    n = len(offsets) - 1
    line = np.searchsorted(offsets, starts, "right") - 1
    _, codes = np.unique(span_hashes(data, starts, ends), return_inverse=True)
    distinct = np.unique(line * (len(codes) + 1) + codes) // (len(codes) + 1)
    return np.bincount(line, minlength=n) - np.bincount(distinct, minlength=n)


def _repeat_words(texts: Texts) -> np.ndarray:
    words = texts.words
    grams, doc = gram_hashes(words.hashes(lower=False), WINDOW), words.docs()
    at = np.flatnonzero(doc[: len(grams)] == doc[len(doc) - len(grams) :])
    _, codes, counts = np.unique(grams[at], return_inverse=True, return_counts=True)
    several = counts[codes] > 1  # in the batch; most are not
    at, codes = at[several], codes[several]
    _, codes, counts = np.unique(doc[at] * (len(counts) + 1) + codes, return_inverse=True, return_counts=True)
    at = at[counts[codes] > 1]
    change = np.zeros(len(doc) + 1, np.int64)
    change[at] += 1
    np.add.at(change, at + WINDOW, -1)
    covered = np.r_[0, np.cumsum(np.cumsum(change[:-1]) > 0)]
    return np.diff(covered[words.first])


def _distinct_words(texts: Texts) -> np.ndarray:
    words = texts.words
    _, codes = np.unique(words.hashes(), return_inverse=True)
    return np.bincount(np.unique(words.docs() * (len(codes) + 1) + codes) // (len(codes) + 1), minlength=len(texts))


FEATURES: dict[str, Callable[[Texts], np.ndarray]] = {
    "n_words": lambda t: t.words.counts(),
    "word_chars": lambda t: t.count(_WORD_CHAR),
    "n_symbols": lambda t: t.count(_SYMBOL),
    "n_dup_lines": _dup_lines,
    "n_repeat_words": _repeat_words,
    "n_lines": lambda t: t.count(_flags("\n")) + 1,
    "n_letters": lambda t: t.count(_LETTER),
    "n_capitals": lambda t: t.count(_CAPITAL),
    "n_distinct_words": _distinct_words,
}


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Texts], np.ndarray]


def _few_words(t: Texts) -> np.ndarray:
    return t["n_words"] < 10


def _repeats(t: Texts) -> np.ndarray:
    return 100 * t["n_repeat_words"] > 20 * t["n_words"]


def _symbols(t: Texts) -> np.ndarray:
    return 5 * t["n_symbols"] > t["n_words"]


def _word_length(t: Texts) -> np.ndarray:
    return (t["word_chars"] < 2 * t["n_words"]) | (t["word_chars"] > 20 * t["n_words"])


def _capitals(t: Texts) -> np.ndarray:
    return 5 * t["n_capitals"] > 2 * t["n_letters"]


def _no_letters(t: Texts) -> np.ndarray:
    return 3 * t["n_letters"] < t["word_chars"]


def _same_lines(t: Texts) -> np.ndarray:
    return 2 * t["n_dup_lines"] > t["n_lines"]


def _same_words(t: Texts) -> np.ndarray:
    return (t["n_words"] >= 50) & (t["n_words"] > 50 * t["n_distinct_words"])


BASE = ("few_words", "repeats")
RULES = (
    Rule("few_words", _few_words),
    Rule("repeats", _repeats),
    Rule("symbols", _symbols),
    Rule("word_length", _word_length),
    Rule("capitals", _capitals),
    Rule("no_letters", _no_letters),
    Rule("same_lines", _same_lines),
    Rule("same_words", _same_words),
)


def ordered(sample: pa.Array, rules: tuple[Rule, ...] = RULES, given: tuple[str, ...] = ()) -> tuple[Rule, ...]:
    """Rules by rejections per second, each on what the ones before it leave of the sample; ``given`` features cost nothing.

    Rules that reject nothing of what is left follow by their rejections per second of the whole sample.
    """
    if not len(sample):
        return rules
    texts = Texts(sample)
    for name in given:
        texts[name]

    def worth(rule: Rule) -> float:
        own = texts.again()
        began = time.perf_counter()
        rejected = int(np.count_nonzero(rule.rejects(own)))
        return rejected / max(time.perf_counter() - began, 1e-9)

    first = {rule.name: worth(rule) for rule in rules}
    out: list[Rule] = []
    while len(out) < len(rules):
        left = [rule for rule in rules if rule not in out]
        best = max(left, key=lambda rule: (worth(rule) if len(texts) else 0.0, first[rule.name]))
        out.append(best)
        texts = texts.where(~best.rejects(texts))
    return tuple(out)


def cascade(texts: Texts, rules: tuple[Rule, ...]) -> np.ndarray:
    """Whether each text passes all rules; a rule sees only what passed those before."""
    kept = np.arange(len(texts))
    for rule in rules:
        if not len(kept):
            break
        passed = ~rule.rejects(texts)
        kept, texts = kept[passed], texts.where(passed)
    return kept


def sample_of(docs: DataFrame, size: int = SAMPLE) -> pa.Array:
    rows = docs.where(F.octet_length("text") <= SAMPLE_BYTES)
    return column(least_hashes(rows, size, []).select("text").toArrow(), "text")


_COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_OUT = pa.schema([("doc_id", pa.int64()), *((x, pa.int64()) for x in _COUNTS), ("base_failed", pa.bool_()), ("kept", pa.bool_())])


def _judge(order: list[str]):
    def make(batches):
        rules = tuple({r.name: r for r in RULES}[x] for x in order)
        for batch in slices(batches):
            texts = Texts(column(batch, "text"))
            counts = [texts[x] for x in _COUNTS]
            failed = _few_words(texts) | _repeats(texts)
            kept = np.zeros(len(texts), bool)
            kept[cascade(texts, rules)] = True
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), *map(pa.array, counts), pa.array(failed), pa.array(kept)], schema=_OUT)

    return make


def judge_quality(docs: DataFrame) -> DataFrame:
    """Counts of every text and whether it is kept.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed (under ten words, or over a fifth of
    the words in repeated windows), kept (no rule rejects it; base_failed is two of the rules).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [r.name for r in ordered(sample_of(rows.where("doc_id is not null")), given=_COUNTS)]
    return rows.mapInArrow(_judge(order), "doc_id long, " + ", ".join(f"{x} long" for x in _COUNTS) + ", base_failed boolean, kept boolean")
