"""Language identification by segmentation-marginalised piece unigrams.

The vocabulary is fixed and public; only the probability of each piece in each language is learned. A word's
probability in a language is the sum over all its segmentations into pieces of the products of their probabilities, by the
forward algorithm; a text's is the product over its words. The probabilities are learned by expectation-maximisation with
the forward-backward algorithm on word counts of a sample: ``SAMPLE`` labelled documents of each language at most, those of the
least hashes, none longer than ``SAMPLE_BYTES``. Everything else covers all rows.

Words are runs of letters in lower case with a mark before them, whole whatever their length; single bytes are pieces of every
vocabulary, so every word has a probability. Sums are scaled anew every ``RESCALE`` bytes, so that long runs, as in scripts
without spaces, neither overflow nor vanish. Distinct words of a batch are scored once, words of like length side by side.

``lang_pred`` is ``und`` with score 0 where the text is null or has no letter, and everywhere if nothing can be learned from.
Rows with null lang, or null doc_id, are not learned from. Ties go to the language first in the alphabet. An empty table gives
an empty result; repeated rows are judged each.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovent.llm.sampling import least_hashes
from heliovent.llm.text import column, gather, runs, slices, span_hashes, text_bytes
from heliovent.llm.tokens import lower_latin

SAMPLE, SAMPLE_BYTES = 400, 1 << 20
RESCALE = 32  # bytes; sums over this many stay in range
FEW = 8  # words side by side below which they are summed one by one
SIDE_BY_SIDE = 480_000  # bytes of words in a table, about
ROUNDS = 4
SPREAD = 12.0  # expected gain of each byte, so that products of a word stay in range
MARK, PAD = 0x20, 0x100
HELD_OUT = 2

_OUT = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())])
_COUNT = pa.schema([("lang", pa.string()), ("word", pa.binary()), ("n", pa.int64())])

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0x80:] = True


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of letters; other signs above ASCII count as letters, but for Latin-1 signs and general punctuation."""
    out = _LETTER[data]
    at = np.flatnonzero(data[:-1] == 0xC2)
    at = at[(data[at + 1] != 0xAA) & (data[at + 1] != 0xB5) & (data[at + 1] != 0xBA)]
    out[at] = out[at + 1] = False
    at = np.flatnonzero((data[:-2] == 0xE2) & (data[1:-1] == 0x80))
    out[at] = out[at + 1] = out[at + 2] = False
    return out


def _widths(lengths: np.ndarray) -> np.ndarray:
    """To how many bytes words are padded: not at all up to ``RESCALE``, then by an eighth at most."""
    step = np.maximum(1, 1 << np.maximum(0, np.log2(np.maximum(1, lengths)).astype(np.int64) - 3))
    return np.where(lengths <= RESCALE, lengths, -(-lengths // step) * step)


def tables(lengths: np.ndarray, letters: Callable[[np.ndarray], np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Words of like length side by side: their numbers, and a column each of the mark, their bytes and padding (``PAD``).

    letters: the bytes of the words with these numbers, all in a row.
    """
    widths = _widths(lengths)
    order = np.argsort(widths, kind="stable")
    new = np.flatnonzero(np.r_[True, np.diff(widths[order]) > 0]).tolist() if len(order) else []
    for a, b in zip(new, [*new[1:], len(order)]):
        width = int(widths[order[a]])
        most = max(1, SIDE_BY_SIDE // (width + 1))
        for c in range(a, b, most):
            at = order[c : min(b, c + most)]
            n = lengths[at]
            table = np.full((width + 1, len(at)), PAD, np.int16)
            table[0] = MARK
            table[gather(n, np.ones(len(n), np.int64)), np.repeat(np.arange(len(n)), n)] = letters(at)
            yield at, table


class _Words:
    """Words of a batch of texts, and which distinct word each is."""

    def __init__(self, texts: pa.Array):
        raw, self.offsets = text_bytes(texts)
        self.raw = raw
        self.data = lower_latin(raw)
        self.starts, self.ends = runs(_letters(raw), self.offsets)
        self.first = np.searchsorted(self.starts, self.offsets)
        _, self.one, self.which = np.unique(span_hashes(self.data, self.starts, self.ends), return_index=True, return_inverse=True)

    def tables(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Distinct words, side by side."""
        starts, lengths = self.starts[self.one], (self.ends - self.starts)[self.one]
        return tables(lengths, lambda at: self.data[gather(lengths[at], starts[at])])


class PieceModel:
    """A trie of pieces with a probability in each language at the nodes that end one."""

    def __init__(self, pieces: list[bytes], languages: list[str], chances: np.ndarray | None = None):
        self.pieces, self.languages = pieces, languages
        symbols = [*sorted({b for p in pieces for b in p}), PAD]  # no path goes on over the padding
        self.symbol = np.zeros(PAD + 1, np.int32)
        self.symbol[symbols] = np.arange(len(symbols))
        rows: list[list[int]] = [[0] * len(symbols)]
        self.node = np.zeros(len(pieces), np.int64)
        number = dict(zip(symbols, range(len(symbols))))
        for i, piece in enumerate(pieces):
            at = 0
            for b in piece:
                to = rows[at][number[b]]
                if not to:
                    to = rows[at][number[b]] = len(rows)
                    rows.append([0] * len(symbols))
                at = to
            self.node[i] = at
        self.next = np.array(rows, np.int32)
        self.size = np.array([len(p) for p in pieces])
        self.longest = int(self.size.max(initial=1))
        self.set(np.full((len(pieces), len(languages)), 1 / len(pieces)) if chances is None else chances)

    def set(self, chances: np.ndarray) -> None:
        self.chances = chances
        self.at_node = np.zeros((len(self.next), len(self.languages)))
        self.at_node[self.node] = chances * SPREAD ** self.size[:, None]

    def _steps(self, table: np.ndarray, start: int):
        """Words in which a path of the trie begins at ``start``: their numbers, the nodes, and the place after."""
        node, words = np.zeros(table.shape[1], np.int64), np.arange(table.shape[1])
        for k in range(start, len(table)):
            node = self.next[node, table[k, words]]
            alive = node > 0
            if not alive.all():
                node, words = node[alive], words[alive]
                if not len(node):
                    return
            yield words, node, k + 1

    def _scaled(self, out: np.ndarray, at: np.ndarray, active: np.ndarray) -> np.ndarray:
        """Divide the rows ``at`` of the sums by their largest, where ``active``; the logarithms of what they were divided by."""
        most = np.where(active[:, None], out[at].max(axis=0), 1.0)
        most[most <= 0] = 1.0
        out[at] /= most
        return np.log(most)

    def log_totals(self, table: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Logarithm of the sum over all segmentations of each word [word, language]; ends: their bytes, the mark included.

        Sums are held for as many places as the longest piece has, so memory does not grow with a word.
        """
        if table.shape[1] <= FEW and len(table) > RESCALE:
            return np.array([self._log_total(table[:end, i].tolist()) for i, end in enumerate(ends.tolist())])
        ring = self.longest + 1
        out = np.zeros((ring, table.shape[1], len(self.languages)))
        out[0] = 1
        logs = np.zeros(out.shape[1:])
        total = np.zeros_like(logs)
        for start in range(len(table) + 1):
            done = ends == start
            if done.any():
                total[done] = np.log(np.maximum(out[start % ring, done], 1e-300)) + logs[done]
            if start == len(table):
                break
            if start % RESCALE == 0 and start:
                logs += self._scaled(out, np.arange(ring), ends > start)
            for words, node, to in self._steps(table, start):
                out[to % ring, words] += out[start % ring, words] * self.at_node[node]
            out[start % ring] = 0
        return total

    @functools.cached_property
    def _paths(self) -> tuple[list[dict[int, int]], dict[int, list[float]]]:
        """The trie's branches and weights for walks of one word."""
        branches = [{s: int(row[s]) for s in np.flatnonzero(row).tolist()} for row in self.next]
        return branches, {n: self.at_node[n].tolist() for n in self.node.tolist()}

    def _log_total(self, word: list[int]) -> list[float]:
        """log_totals of one long word, where numpy's calls would cost more than the sums."""
        branches, weights = self._paths
        languages = range(len(self.languages))
        ring = self.longest + 1
        out = [[0.0] * len(languages) for _ in range(ring)]
        out[0] = [1.0] * len(languages)
        logs = [0.0] * len(languages)
        for start in range(len(word)):
            if start % RESCALE == 0 and start:
                for k in languages:
                    most = max(sums[k] for sums in out) or 1.0
                    logs[k] += math.log(most)
                    for sums in out:
                        sums[k] /= most
            own, node = out[start % ring], 0
            out[start % ring] = [0.0] * len(languages)
            for at in range(start, len(word)):
                node = branches[node].get(word[at], 0)
                if not node:
                    break
                if node in weights:
                    weight, sums = weights[node], out[(at + 1) % ring]
                    for k in languages:
                        sums[k] += own[k] * weight[k]
        return [math.log(max(x, 1e-300)) + y for x, y in zip(out[len(word) % ring], logs)]

    def expected(self, table: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected number of uses of each node, words weighted by their counts [word, language]."""
        places, shape = len(table) + 1, (table.shape[1], len(self.languages))
        ahead, back = np.zeros((places, *shape)), np.zeros((places, *shape))
        ahead[0] = 1
        back[ends, np.arange(shape[0])] = 1
        blocks = places // RESCALE + 1
        ahead_logs, back_logs = np.zeros((blocks, *shape)), np.zeros((blocks + 1, *shape))
        for start in range(len(table)):
            if start % RESCALE == 0 and start:
                near = np.arange(start, min(places, start + self.longest + 1))
                ahead_logs[start // RESCALE :] += self._scaled(ahead, near, ends > start)
            for words, node, to in self._steps(table, start):
                ahead[to, words] += ahead[start, words] * self.at_node[node]
        number = np.arange(shape[0])
        total = np.log(np.maximum(ahead[ends, number], 1e-300)) + ahead_logs[np.maximum(ends - 1, 0) // RESCALE, number]
        used = np.zeros((len(self.next), shape[1]))
        for start in range(len(table) - 1, -1, -1):
            # a place was divided whenever the sweep passed a multiple of RESCALE at or before it
            if start % RESCALE == RESCALE - 1:
                near = np.arange(start + 1, min(places, start + self.longest + 2))
                factors = self._scaled(back, near, ends > start)
                back_logs[: start // RESCALE + 1] += factors
            of_start, of_back = ahead_logs[start // RESCALE], back_logs[start // RESCALE]
            for words, node, to in self._steps(table, start):
                gain = self.at_node[node] * back[to, words]
                back[start, words] += gain
                gain *= ahead[start, words] * counts[words] * np.exp(of_start[words] + of_back[words] - total[words])
                for k in range(shape[1]):
                    used[:, k] += np.bincount(node, gain[:, k], minlength=len(used))
        return used

    def log_scores(self, table: np.ndarray, ends: np.ndarray | None = None) -> np.ndarray:
        """Log probability of each word in each language; ends: as for ``log_totals``, all of the table if not given."""
        ends = np.full(table.shape[1], len(table)) if ends is None else ends
        return self.log_totals(self.symbol[table], ends) - (ends * np.log(SPREAD))[:, None]


def _pieces(path: str) -> list[bytes]:
    """Lower-case pieces of letters, with or without the mark, and all bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        rest = piece.removeprefix("▁")
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)) and rest.isalpha() and rest == rest.lower():
            out.add((" " if rest != piece else "").encode() + rest.encode())
    return sorted(out)


def _count_words(batches):
    for batch in batches:
        langs = column(batch, "lang").to_pylist()
        for i, lang in enumerate(langs):
            words = _Words(column(batch, "text").slice(i, 1))
            counts = np.bincount(words.which, minlength=len(words.one))
            found = [words.data[words.starts[k] : words.ends[k]].tobytes() for k in words.one]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(found), pa.string()), pa.array(found, pa.binary()), pa.array(counts, pa.int64())], schema=_COUNT)


def learn(docs: DataFrame, path: str, rounds: int = ROUNDS) -> PieceModel | None:
    """Piece probabilities of each language of the labelled rows (doc_id, text, lang) given; None without any."""
    labelled = docs.where("lang is not null and text is not null and doc_id is not null")
    labelled = labelled.where(F.octet_length("text") <= SAMPLE_BYTES)
    chosen = least_hashes(labelled, SAMPLE, ["lang"])
    rows = chosen.select("lang", "text").mapInArrow(_count_words, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    languages = sorted(set(rows["lang"].to_pylist()))
    if not languages:
        return None
    numbers = {x: i for i, x in enumerate(languages)}
    counts: dict[bytes, list[float]] = {}
    for lang, word, n in zip(*(rows[x].to_pylist() for x in ("lang", "word", "n"))):
        counts.setdefault(word, [0.0] * len(languages))[numbers[lang]] += n
    words = list(counts)
    weights = np.array([counts[w] for w in words]).reshape(len(words), len(languages))
    lengths = np.array([len(w) for w in words], np.int64)
    model = PieceModel(_pieces(path), languages)
    for _ in range(rounds):
        used = np.zeros(model.at_node.shape)
        for at, table in tables(lengths, lambda at: np.frombuffer(b"".join(words[i] for i in at.tolist()), np.uint8)):
            used += model.expected(model.symbol[table], lengths[at] + 1, weights[at])
        used = used[model.node] + 0.05
        keep = (used.max(axis=1) > 0.5) | (model.size == 1)
        model = PieceModel([p for p, k in zip(model.pieces, keep) if k], languages, used[keep] / used[keep].sum(axis=0))
    return model


def _judged(model: PieceModel, texts: pa.Array) -> tuple[list[str], np.ndarray]:
    """Language and score of each text."""
    languages = model.languages
    words = _Words(texts)
    scores = np.zeros((len(words.one), len(languages)))
    lengths = (words.ends - words.starts)[words.one]
    for at, table in words.tables():
        scores[at] = model.log_scores(table, lengths[at] + 1)
    n = np.diff(words.first)
    total = np.zeros((len(n), len(languages)))
    full = np.flatnonzero(n)
    if len(full):
        for k in range(len(languages)):
            total[full, k] = np.add.reduceat(scores[words.which, k], words.first[full])
    latin = np.r_[0, np.cumsum(_LETTER[words.raw] & (words.raw < 0x80))]
    known = np.diff(latin[words.offsets]) > 0
    for i in np.flatnonzero((n > 0) & ~known):  # no A-Z: is any of the other signs a letter?
        known[i] = any(map(str.isalpha, words.raw[words.offsets[i] : words.offsets[i + 1]].tobytes().decode()))
    best = total.argmax(axis=1)
    score = 1 / np.exp(total - total[np.arange(len(n)), best][:, None]).sum(axis=1)
    return [languages[b] if k else "und" for b, k in zip(best.tolist(), known.tolist())], np.where(known, score, 0.0)


def _predict(model):
    def make(batches):
        for batch in slices(batches):
            lang, score = _judged(model.value, column(batch, "text"))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "held_out"), pa.array(lang, pa.string()), pa.array(score)], schema=_OUT)

    return make


def _accept(model, least: float):
    def make(batches):
        for batch in slices(batches):
            lang, score = _judged(model.value, column(batch, "text"))
            yield batch.filter(pa.array((np.array(lang, object) != "und") & (score >= least)))

    return make


def _training(docs: DataFrame, folds: int) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    return rows.where(F.crc32(F.col("doc_id").cast("string")) % folds != HELD_OUT)


def keep_identified(docs: DataFrame, least: float = 0.5, path: str | None = None, folds: int = 4) -> DataFrame:
    """The rows, as they are, of texts in a learned language with a score of at least ``least``."""
    model = learn(_training(docs, folds), path or vocabulary())
    if model is None:
        return docs.where("false")
    return docs.mapInArrow(_accept(docs.sparkSession.sparkContext.broadcast(model), least), docs.schema)


def identify(docs: DataFrame, path: str | None = None, folds: int = 4) -> DataFrame:
    """Language of every text, learned from rows with a lang whose crc32(doc_id) mod ``folds`` is not 2.

    Returns doc_id, held_out (that remainder is 2), lang_pred, score (its probability among the learned languages).
    """
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == HELD_OUT, F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", held.alias("held_out"))
    model = learn(_training(docs, folds), path or vocabulary())
    if model is None:
        return rows.select("doc_id", "held_out", F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)  # bounded by the vocabulary
    return rows.select("doc_id", "held_out", "text").mapInArrow(_predict(shared), "doc_id long, held_out boolean, lang_pred string, score double")
