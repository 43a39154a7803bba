import math
import zlib
from collections import Counter

import numpy as np
import pytest

from heliovent.llm import lm_scoring as lm
from tests.llm import brute


@pytest.fixture(scope="module")
def scored(docs):
    return lm.score_texts(docs).collect()


def fold(i, n=5):
    return 2 if i is None else zlib.crc32(str(i).encode()) % n


def test_counts_and_base_equal_plain_loops(scored, rows):
    tokens = [(i, [*brute.words(t), None]) for i, t in rows]
    count = Counter(w for i, ws in tokens if fold(i) != 1 for w in ws)
    n, v = sum(count.values()), len(count)
    want = sorted((repr(i), fold(i) == 1, len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 4)) for i, ws in tokens)
    got = sorted((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in scored)
    assert [x[:-1] for x in got] == [x[:-1] for x in want]
    assert np.allclose([x[-1] for x in got], [x[-1] for x in want])


def test_score_is_the_mixture_of_plain_counts(scored, rows):
    """The learned weights are those that reproduce every row's score from plain counts."""
    tokens = [(i, [*brute.words(t), None]) for i, t in rows]
    train = [ws for i, ws in tokens if fold(i) != 1]
    main = [ws for i, ws in tokens if fold(i) not in (0, 1)]
    tune = [ws for i, ws in tokens if fold(i) == 0]

    def model(texts):
        one = Counter(w for ws in texts for w in ws)
        two = Counter(p for ws in texts for p in zip(["<s>", *ws], ws))
        context = Counter(c for ws in texts for c in ["<s>", *ws[:-1]])
        n, v = sum(one.values()), len(one)

        def estimates(before, w):
            base = (one[w] + 0.5) / (n + 0.5 * (v + 1))
            c = context[before]
            return base, (int(math.log2(c)) if c else -1), (two[before, w] / c if c else 0.0)

        return estimates

    held = Counter()
    estimates = model(main)
    for ws in tune:
        for before, w in zip(["<s>", *ws], ws):
            base, bucket, pair = estimates(before, w)
            if bucket >= 0:
                ratio = pair / base
                held[bucket, round(math.log2(ratio) * lm.STEPS) + lm.SPAN + 1 if ratio else 0] += 1
    weights = [*lm.learn_weights([(k, b, n) for (k, b), n in held.items()]), 0.0]
    estimates = model(train)
    want = []
    for i, ws in tokens:
        total = 0.0
        for before, w in zip(["<s>", *ws], ws):
            base, bucket, pair = estimates(before, w)
            total += math.log10(weights[bucket] * pair + (1 - weights[bucket]) * base)
        want.append((repr(i), len(ws), round(total, 3)))
    got = sorted((repr(r.doc_id), r.n_tokens, r.score) for r in scored)
    assert np.allclose([x[2] for x in got], [x[2] for x in sorted(want)], rtol=1e-3)


def test_held_out_texts_are_likelier_than_under_the_base(scored):
    held = [r for r in scored if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_expectation_maximisation_finds_the_best_weight():
    histogram = [(3, lm.SPAN + 1 + 2 * lm.STEPS, 60), (3, 0, 40)]  # ratio 4, and 0
    weight = lm.learn_weights(histogram)[3]

    def likelihood(w):
        return 60 * math.log(4 * w + 1 - w) + 40 * math.log(1 - w)

    assert all(likelihood(weight) >= likelihood(w) for w in np.linspace(0.001, 0.999, 999))
    assert lm.learn_weights(histogram)[10] == weight  # no tokens there: as the one below
    assert lm.learn_weights([]) == [0.0] * lm.BUCKETS


def test_empty_table_and_no_training_text(spark, nothing):
    assert lm.score_texts(nothing).count() == 0
    held = next(i for i in range(100) if fold(i) == 1)
    (row,) = lm.score_texts(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).collect()
    assert (row.train_tokens, row.n_known, row.held_out) == (0, 0, True) and row.base_score == row.score == 0.0
