import hashlib
import struct
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece

from heliovent.llm import sentencepiece_codec as sp

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def scores():
    model = sentencepiece.SentencePieceProcessor(model_file=PATH)
    return {
        model.id_to_piece(i): model.get_score(i)
        for i in range(model.get_piece_size())
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or "▁" in model.id_to_piece(i)[1:])
    }


def best(word, scores, unknown):
    out = [0.0]
    for end in range(1, len(word) + 1):
        found = [out[a] + scores[word[a:end]] for a in range(end) if word[a:end] in scores]
        if word[end - 1] not in scores:
            found.append(out[end - 1] + unknown)
        out.append(max(found))
    return out[-1]


def test_segmentations_are_the_best(scores, rows):
    codec = sp.Codec(PATH)
    names = {i: p for p, i in ((p.replace(b" ", "▁".encode()).decode(errors="replace"), i) for i, p in enumerate(codec.pieces))}
    words = sorted({"▁" + w for _, t in rows[:60] for w in (t or "").split(" ")} | {"▁日本", "▁", "▁x\ny", "▁naïve😀"})
    for word, ids in zip(words, codec.encode_sorted(words)):
        total, spelled = 0.0, 0
        for i in ids:
            if i in codec.byte_id:
                spelled += 1
            else:
                total += scores[names[i]]
        unknown = [c for c in word if c not in scores]
        assert spelled == sum(len(c.encode()) for c in unknown)
        assert abs(total + codec.unknown * len(unknown) - best(word, scores, codec.unknown)) < 1e-3


def test_shared_prefixes_change_nothing():
    codec = sp.Codec(PATH)
    words = sorted(["▁the", "▁them", "▁theme", "▁then", "▁t", "▁", "▁other"])
    assert codec.encode_sorted(words) == [codec.encode_sorted([w])[0] for w in words]


def test_round_trip_of_rows(docs, rows):
    got = sp.encode_texts(docs, with_ids=True).cache()
    listed = got.collect()
    assert sorted((repr(r.doc_id), r.decoded_sha256) for r in listed) == sorted((repr(i), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in rows)
    assert all(r.n_pieces == len(r.ids) and r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(r.ids)}I", *r.ids)) for r in listed)
    assert sorted((repr(r.doc_id), r.text) for r in sp.decode_ids(got).collect()) == sorted((repr(i), t or "") for i, t in rows)
    assert "ids" not in sp.encode_texts(docs).columns


@pytest.mark.parametrize("text", ["", " ", "  ", "a  b ", "▁", " ▁ a▁", "\n\t", "x" * 5000, "𝕏 é😀"])
def test_texts_are_restored(text):
    encode = sp.Encoder(PATH)
    ids, counts = encode(pa.array([text, None, text]))
    assert [t.decode() for t in encode.codec.decode(ids, counts)] == [text, "", text]


def test_empty_table(nothing):
    assert sp.encode_texts(nothing).count() == 0
