import hashlib
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from heliovent.llm import periodic_runs as pr
from heliovent.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import DATA


def plain_runs(words, least):
    """(start, end, smallest period) of all runs, period by period."""
    out = []
    for q in range(1, len(words) // 2 + 1):
        same = [a == b for a, b in zip(words, words[q:])] + [False]
        start = None
        for i, equal in enumerate(same):
            if equal and start is None:
                start = i
            elif not equal and start is not None:
                end = i + q
                if end - start >= max(least, 2 * q) and not any(s <= start and end <= e and q % p == 0 for s, e, p in out):
                    out.append((start, end, q))
                start = None
    return sorted(out)


def plain_lyndon(word):
    """Longest Lyndon prefix of each suffix: up to the next smaller suffix, by comparing all."""
    return [next((j for j in range(i + 1, len(word)) if word[j:] < word[i:]), len(word)) - i for i in range(len(word))]


def laid_out(strings):
    return np.array([x for s in strings for x in (0, *s)], np.int64)


STRINGS = st.lists(st.lists(st.integers(1, 3), min_size=1, max_size=50), min_size=1, max_size=4)


@given(STRINGS)
@settings(max_examples=200, deadline=None)
def test_lyndon_words_under_both_orders(strings):
    symbols = laid_out(strings)
    for flip in (False, True):
        words = [[4 - x for x in s] if flip else s for s in strings]
        got = pr.lyndon_array(laid_out(words))
        want = [x for w in words for x in (None, *plain_lyndon(w))]
        assert [g for g, w in zip(got, want) if w] == [w for w in want if w]
    assert len(symbols) == len(got)


@given(STRINGS, st.sampled_from([2, 6, 12]))
@settings(max_examples=300, deadline=None)
def test_runs_of_short_strings(strings, least):
    at, want = 0, []
    for s in strings:
        want += [(a + at + 1, b + at + 1, q) for a, b, q in plain_runs(s, least)]
        at += len(s) + 1
    assert list(zip(*(x.tolist() for x in pr.runs_of(laid_out(strings), least)))) == sorted(want, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("word", [[1] * 300, [1, 2] * 200, [1, 2, 3, 1, 2] * 60, [bin(i).count("1") % 2 + 1 for i in range(600)], [1, 1, 2] * 40 + [1, 1] * 30 + [2, 1, 1] * 20])
def test_regular_strings(word):
    got = list(zip(*(x.tolist() for x in pr.runs_of(laid_out([word]), 12))))
    assert got == sorted((a + 1, b + 1, q) for a, b, q in plain_runs(word, 12))


def test_extension_counts_equal_values():
    values = pr.mix(np.array([1, 2, 3] * 50 + [9] + [1, 2, 3] * 50, np.uint64))
    i, j = np.array([0, 0, 150, 301, 2]), np.array([3, 151, 0, 0, 5])
    assert pr.Extension(values)(i, j).tolist() == [147, 150, 0, 0, 145]


def words_of(doc_id, text, planted):
    words = brute.WORD.findall(text or "")
    n = len(words)
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if planted and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def expected(rows, planted=True):
    out = []
    for i, text in rows:
        words = words_of(i, text, planted)
        if len(words) == len(set(words)):
            runs = []
        else:
            runs = plain_runs(words, 12) if len(words) < 3000 else None
        if runs is None:
            continue
        dropped = {k for s, e, q in runs for k in range(s + q, e)}
        kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
        ordered = sorted((s, e - s, q) for s, e, q in runs)
        best = min(ordered, key=lambda r: (-r[1], r[0], r[2])) if runs else (None,) * 3
        digest = hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in ordered).encode()).hexdigest()
        milli = 1000 * best[1] // best[2] if runs else None
        out.append((i, len(runs), *best, milli, digest, hashlib.sha256(kept.encode()).hexdigest()))
    return out


def test_query_equals_plain_loops(spark, docs, rows):
    got = pr.run_digests(pr.find_runs(docs, plant=pr.planted_period)).collect()
    want = expected(rows)
    found = {}
    for r in map(tuple, got):
        found.setdefault(r[0], []).append(r)
    assert len(got) == len(rows) and len(want) > 0.8 * len(rows) and sum(r[1] > 0 for r in want) > 5
    assert all(w in found[w[0]] for w in want)


def test_whole_table_of_the_query(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: tuple(r) for r in QUERIES["op12_periodic_runs"](spark, DATA).collect()}
    assert len(got) == len(rows) and all(got[w[0]] == w for w in expected(rows))


def test_runs_and_collapsed_texts(spark):
    lines = "a b c d e f\n"
    long = " ".join(f"w{i % 1500}" for i in range(40_000))
    rows = [(1, lines * 3 + "end"), (2, "x " * 11), (3, "x " * 12), (4, "X x " * 12), (5, None), (6, ""), (7, long), (7, "once only"), (None, "y\ty\n" * 8)]
    got = {(r.doc_id, r.collapsed): [tuple(x) for x in r.runs] for r in pr.find_runs(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {
        (1, "a b c d e f end"): [(0, 18, 6)],
        (2, " ".join("x" * 11)): [],
        (3, "x"): [(0, 12, 1)],
        (4, "X x"): [(0, 24, 2)],
        (5, ""): [],
        (6, ""): [],
        (7, " ".join(f"w{i}" for i in range(1500))): [(0, 40_000, 1500)],
        (7, "once only"): [],
        (None, "y"): [(0, 16, 1)],
    }


def test_empty_table(nothing):
    assert pr.run_digests(pr.find_runs(nothing)).count() == 0


def test_nothing_is_shuffled(docs):
    plan = pr.run_digests(pr.find_runs(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
