"""SentencePiece encoding and decoding by a shared-prefix Viterbi search.

Spaces become marks, one more goes before the text, and every mark begins a word, so a text's best segmentation is
that of its words. The distinct words of a batch, sorted, are the leaves of a trie met depth first: a word keeps the forward
scores of the prefix it shares with the one before and extends from there. Each place takes the best sum of a score before
it and a piece that ends at it; pieces are found backwards in a trie of reversed pieces. Among equal sums the
longest last piece wins. Scores are the vocabulary's own; a character that is no piece by itself costs ten more than the
worst piece and becomes its bytes. Decoding joins the pieces and drops the mark in front.

The scores of a BPE vocabulary are ranks of merges. The best sum of ranks is not what merging gives: ids and counts of pieces
differ from those of the SentencePiece library for such a file (figures in the README).

Decoding restores every text exactly, white space, marks in the text and unknown characters included. Null text: empty, no
pieces. A null doc_id stays null; repeated rows are encoded each. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from heliovent.llm.text import column, gather, slices, span_hashes, text_bytes

MARK = "▁"
_OWN_MARK = "\ud800"  # a mark of the text itself; no valid text holds this
CACHED = 400_000  # distinct words a worker keeps; it starts anew beyond that


class Codec:
    """Pieces and scores of a vocabulary file."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces: list[bytes] = []
        self.byte_id = [0] * 256
        self.backwards: dict = {}
        worst = 0.0
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[1:-1], 16)] = i
                self.pieces.append(bytes([int(piece[1:-1], 16)]))
                continue
            special = model.is_control(i) or model.is_unknown(i) or model.is_unused(i)
            self.pieces.append(b"" if special else piece.replace(MARK, " ").encode())
            if special or MARK in piece[1:]:
                continue  # a mark begins a word
            score = model.get_score(i)
            worst = min(worst, score)
            node = self.backwards
            for c in reversed(piece):
                node = node.setdefault(c, {})
            node[""] = (score, i)
        self.unknown = worst - 10
        self.sizes = np.array([len(p) for p in self.pieces])
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.joined = np.frombuffer(b"".join(self.pieces), np.uint8)

    def encode_sorted(self, words: list[str]) -> list[list[int]]:
        """Ids of distinct words, given in ascending order."""
        best, back, out, last = [0.0], [(0, -1)], [], ""
        root, unknown, nothing = self.backwards, self.unknown, float("-inf")
        for word in words:
            shared = 0
            for a, b in zip(word, last):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], back[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                node = root.get(word[end - 1])
                top, step = nothing, (1, -1)
                if node is None or "" not in node:
                    top = best[end - 1] + unknown
                at = end - 1
                while node is not None:
                    found = node.get("")
                    if found is not None:
                        sum_ = best[at] + found[0]
                        if sum_ >= top:
                            top, step = sum_, (end - at, found[1])
                    if not at:
                        break
                    at -= 1
                    node = node.get(word[at])
                best.append(top)
                back.append(step)
            ids: list[int] = []
            end = len(word)
            while end:
                length, i = back[end]
                if i < 0:
                    c = word[end - 1]
                    ids += [self.byte_id[b] for b in reversed((MARK if c == _OWN_MARK else c).encode())]
                else:
                    ids.append(i)
                end -= length
            ids.reverse()
            out.append(ids)
            last = word
        return out

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts of ids in a row, ``counts`` of each."""
        sizes = self.sizes[ids]
        data = self.joined[gather(sizes, self.begins[ids])].tobytes()
        at = np.r_[0, np.cumsum(sizes)][np.r_[0, np.cumsum(counts)]].tolist()
        return [data[a + 1 : b] for a, b in zip(at[:-1], at[1:])]


class Encoder:
    """A worker's codec and the words it has met."""

    def __init__(self, path: str):
        self.codec = Codec(path)
        self.is_byte = np.zeros(len(self.codec.pieces), bool)
        self.is_byte[self.codec.byte_id] = True
        self.known: dict[int, np.ndarray] = {}

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and how many each text has."""
        data, offsets = text_bytes(texts)
        spaces = np.flatnonzero(data == 0x20)
        full = np.diff(offsets) > 0
        starts = np.sort(np.r_[offsets[:-1][full], spaces + 1])
        ends = np.sort(np.r_[spaces, offsets[1:][full]])
        words = np.diff(np.searchsorted(spaces, offsets)) + full
        hashes, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > CACHED:
            self.known.clear()
        hashes = hashes.tolist()
        fresh = [(MARK + data[starts[i] : ends[i]].tobytes().decode().replace(MARK, _OWN_MARK), h) for h, i in zip(hashes, first.tolist()) if h not in self.known]
        fresh.sort()
        for (_, h), ids in zip(fresh, self.codec.encode_sorted([w for w, _ in fresh])):
            self.known[h] = np.array(ids, np.uint32)
        ids = [self.known[h] for h in hashes]
        sizes = np.array([len(x) for x in ids], np.int64)
        flat = np.concatenate([np.zeros(0, np.uint32), *ids])
        out = flat[gather(sizes[which], (np.cumsum(sizes) - sizes)[which])]
        at = np.r_[0, np.cumsum(sizes[which])][np.r_[0, np.cumsum(words)]]
        return out, np.diff(at)


_encoders: dict[str, Encoder] = {}
_OUT = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("n_byte_pieces", pa.int64()), ("ids_crc32", pa.int64()), ("decoded_sha256", pa.string()), ("ids", pa.list_(pa.int32()))])


def _encode(path: str, with_ids: bool):
    def make(batches):
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        encode = _encoders[path]
        for batch in slices(batches, most=8 << 20):
            ids, counts = encode(column(batch, "text"))
            at = np.r_[0, np.cumsum(counts)]
            spelled = np.diff(np.r_[0, np.cumsum(encode.is_byte[ids])][at])
            crc = [zlib.crc32(ids[a:b].astype("<u4")) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            sha = [hashlib.sha256(x).hexdigest() for x in encode.codec.decode(ids, counts)]
            lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(ids.astype(np.int32))) if with_ids else pa.nulls(len(crc), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(counts), pa.array(spelled), pa.array(crc, pa.int64()), pa.array(sha), lists], schema=_OUT)

    return make


def encode_texts(docs: DataFrame, path: str | None = None, with_ids: bool = False) -> DataFrame:
    """Encode every text and decode it again.

    Returns doc_id, n_pieces, n_byte_pieces, ids_crc32 (of little-endian unsigned 32-bit ids), decoded_sha256 (of the decoded
    text); with_ids: also ``ids``.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = rows.mapInArrow(_encode(path, with_ids), "doc_id long, n_pieces long, n_byte_pieces long, ids_crc32 long, decoded_sha256 string, ids array<int>")
    return out if with_ids else out.drop("ids")


def decode_ids(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text of rows with ``ids``; null ids: an empty text."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("piece_bpe_32k.model")

    def make(batches):
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        for batch in batches:
            ids = column(batch, "ids").fill_null([])
            texts = _encoders[path].codec.decode(ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64), ids.value_lengths().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array([t.decode() for t in texts], pa.string())], names=["doc_id", "text"])

    return encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(make, "doc_id long, text string")
