import numpy as np
import pytest

from heliovent.llm import language_id as li


@pytest.fixture(scope="module")
def judged(docs):
    return li.identify(docs).collect()


def test_held_out_accuracy_and_defined_cases(judged, docs):
    truth = {r.doc_id: (r.lang, r.text) for r in docs.select("doc_id", "lang", "text").collect() if r.doc_id is not None}
    held = [r for r in judged if r.held_out and r.doc_id is not None and r.doc_id < 900_000]
    assert held and sum(r.lang_pred == truth[r.doc_id][0] for r in held) / len(held) > 0.98
    for r in judged:
        assert 0 <= r.score <= 1
        if r.doc_id is not None:
            text = truth[r.doc_id][1]
            assert (r.lang_pred == "und") == (text is None or not any(map(str.isalpha, text)))
            assert r.lang_pred != "und" or r.score == 0
    assert len(judged) == docs.count()


def test_forward_sums_all_segmentations():
    pieces = [b"a", b"b", b"ab", b" a", b" ", b"aba"]
    chances = np.random.default_rng(1).random((len(pieces), 2))
    model = li.PieceModel(pieces, ["x", "y"], chances)

    def every(word, k):
        return 1.0 if not word else sum(chances[i, k] * every(word[len(p) :], k) for i, p in enumerate(pieces) if word.startswith(p))

    for word in (b" ", b" a", b" ababab", b" bbabaab"):
        got = model.log_scores(np.frombuffer(word, np.uint8)[:, None])[0]
        assert np.allclose(np.exp(got), [every(word, k) for k in (0, 1)])


def test_expected_counts_are_the_gradient_of_the_likelihood():
    pieces = [b"a", b"b", b"ab", b" a", b" "]
    chances = np.array([[0.2], [0.3], [0.1], [0.25], [0.15]])
    table = np.frombuffer(b" aab", np.uint8)[:, None]
    model = li.PieceModel(pieces, ["x"], chances)
    used = model.expected(model.symbol[table], np.array([4]), np.ones((1, 1)))[model.node]
    for i in range(len(pieces)):
        more = chances.copy()
        more[i] *= 1 + 1e-6
        slope = (li.PieceModel(pieces, ["x"], more).log_scores(table) - model.log_scores(table)) / 1e-6
        assert abs(used[i, 0] - slope[0, 0]) < 1e-4


PIECES = [b"a", b"b", b"ab", b" a", b" ", b"aba"]


def plain_log(word, chances, k):
    """The forward sum in logarithms, byte by byte."""
    sums = [0.0]
    for i in range(1, len(word) + 1):
        sums.append(np.logaddexp.reduce([sums[i - len(p)] + np.log(chances[q, k]) for q, p in enumerate(PIECES) if word[:i].endswith(p)]))
    return sums[-1]


def words_of(sizes):
    rng = np.random.default_rng(2)
    words = [rng.choice(list(b"ab"), n).astype(np.uint8).tobytes() for n in sizes]
    lengths = np.array([len(w) for w in words])
    return words, lengths, lambda at: np.frombuffer(b"".join(words[i] for i in at.tolist()), np.uint8)


def test_letter_runs_of_any_length_are_summed_whole():
    chances = np.random.default_rng(1).random((len(PIECES), 2)) / 4
    model = li.PieceModel(PIECES, ["x", "y"], chances)
    words, lengths, letters = words_of([1, 2, 5, 31, 32, 33, 40, 41, 47, 48, 49, 63, 64, 65, 100, 1000, 10_000])
    seen = 0
    for at, table in li.tables(lengths, letters):
        got = model.log_scores(table, lengths[at] + 1)
        want = [[plain_log(b" " + words[i], chances, k) for k in (0, 1)] for i in at]
        assert np.allclose(got, want, rtol=1e-12, atol=1e-8)
        seen += len(at)
    assert seen == len(words)


def test_expected_counts_of_long_runs_are_the_gradient():
    chances = np.random.default_rng(1).random((len(PIECES), 2)) / 4
    model = li.PieceModel(PIECES, ["x", "y"], chances)
    words, lengths, letters = words_of([3, 32, 33, 70, 300])
    weights = np.random.default_rng(3).random((len(words), 2))
    used = np.zeros(model.at_node.shape)
    for at, table in li.tables(lengths, letters):
        used += model.expected(model.symbol[table], lengths[at] + 1, weights[at])
    for i in range(len(PIECES)):
        more = chances.copy()
        more[i] *= 1 + 1e-6
        for k in (0, 1):
            slope = sum(w[k] * (plain_log(b" " + x, more, k) - plain_log(b" " + x, chances, k)) for x, w in zip(words, weights)) / 1e-6
            assert used[model.node[i], k] == pytest.approx(slope, rel=1e-3, abs=1e-3)


def test_scripts_without_spaces(spark):
    """Runs of hundreds of bytes, none of which ends at a place that characters do not."""
    signs = {"zh": "的一是不了人我在有他这中大来上国", "ja": "のにはをたがでてとしれさあいるこ"}
    rng = np.random.default_rng(4)
    rows = [(i, "".join(rng.choice(list(signs[lang]), 40 + i)), lang) for i in range(60) for lang in signs]
    rows = [(n, text, lang if n % 3 else None) for n, (_, text, lang) in enumerate(rows)]
    truth = [lang for _ in range(60) for lang in signs]
    got = {r.doc_id: r.lang_pred for r in li.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[n] == truth[n] for n, (_, _, lang) in enumerate(rows) if lang is None)


def test_long_words_are_scored_whole(spark):
    rows = [(i, "aaaa " * 20, "a") for i in range(20)] + [(100 + i, "bbbb " * 20, "b") for i in range(20)] + [(300, "b" * 10_000, None), (301, "a" * 1000 + "b" * 5000, None)]
    got = {r.doc_id: r.lang_pred for r in li.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert got[300] == "b" and got[301] == "b"


def test_no_labels_and_empty_table(spark, nothing):
    rows = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in li.identify(rows).collect()] == [("und", 0.0)]
    assert li.identify(nothing).count() == 0
    assert li.keep_identified(nothing).count() == 0


def test_accepted_rows_are_as_they_were(docs, judged):
    got = li.keep_identified(docs)
    assert got.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in got.select("doc_id").collect()) == sorted(repr(r.doc_id) for r in judged if r.lang_pred != "und" and r.score >= 0.5)
