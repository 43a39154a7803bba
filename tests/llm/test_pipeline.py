import re

import corpus_pipeline as cp
from heliovent.llm import language_id, ngram_join, pii, suffix_dedup
from heliovent.llm.storage import stored
from tests.llm import brute
from tests.llm.conftest import DATA


def test_stages_equal_plain_loops(spark, docs, tmp_path):
    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    start = stored(docs.select(*columns))
    frames = [start]
    for _, stage in cp.STAGES:
        frames.append(stored(stage(spark, frames[-1], DATA)))
    assert all(f.columns == columns for f in frames[:-1])

    def texts(frame):
        return sorted(((r.doc_id, r.text) for r in frame.collect()), key=repr)

    accepted = {(repr(r.doc_id)) for r in language_id.identify(frames[0]).collect() if r.lang_pred != "und" and r.score >= 0.5}
    assert texts(frames[1]) == [x for x in texts(frames[0]) if repr(x[0]) in accepted and x[1] is not None and re.search(r"[^\W\d_]", x[1])]

    heads = {i for i, _, c in brute.jaccard_components(texts(frames[1]), ngram_join.NO_ID) if i == c}
    assert texts(frames[2]) == [x for x in texts(frames[1]) if (ngram_join.NO_ID if x[0] is None else x[0]) in heads]

    gone = [(None if i == suffix_dedup.NO_ID else i, bytes(c for c, g in zip(b, flags) if not g).decode(errors="ignore")) for i, b, flags in brute.removed(texts(frames[2]), suffix_dedup.NO_ID)]
    assert texts(frames[3]) == sorted(gone, key=repr)

    assert texts(frames[4]) == sorted(((i, pii.redacted(t, pii.all_spans(t)[1])) for i, t in texts(frames[3])), key=repr)
    assert all(r.n_chars == len(r.text) for r in frames[4].collect())

    assert {repr(r.doc_id) for r in frames[5].collect()} == {repr(i) for i, _ in texts(frames[4])}


def test_run_over_the_table(spark):
    got = cp.run(spark, DATA)
    assert got.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and got.count() > 100


def test_empty_documents(spark, nothing):
    frame = nothing.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in cp.STAGES:
        frame = stored(stage(spark, frame, DATA))
        assert frame.count() == 0
