import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from heliovent.llm import quality_rules as q
from tests.llm import brute
from tests.llm.conftest import DATA


def test_counts_equal_plain_loops(docs, rows):
    got = sorted((repr(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in q.judge_quality(docs).collect())
    want = []
    for i, t in rows:
        counts = brute.quality(t)
        want.append((repr(i), *counts, counts[0] < 10 or 100 * counts[4] > 20 * counts[0]))
    assert got == sorted(want)


def test_order_never_changes_the_verdict(rows):
    texts = pa.array([t for _, t in rows], pa.string())
    plain = ~np.any([r.rejects(q.Texts(texts)) for r in q.RULES], axis=0)
    for seed in range(5):
        order = np.random.default_rng(seed).permutation(len(q.RULES))
        kept = np.zeros(len(texts), bool)
        kept[q.cascade(q.Texts(texts), tuple(q.RULES[i] for i in order))] = True
        assert (kept == plain).all()


def test_a_rule_sees_only_what_passed_before():
    seen = []

    def note(name, rejects):
        def rule(t):
            seen.append((name, len(t)))
            return rejects(t)

        return q.Rule(name, rule)

    texts = q.Texts(pa.array(["a", "b c", "d e f", None]))
    kept = q.cascade(texts, (note("one", lambda t: t["n_words"] < 2), note("two", lambda t: t["n_words"] > 2), note("three", lambda t: t["n_words"] > 0), note("four", lambda t: t["n_words"] > 0)))
    assert seen == [("one", 4), ("two", 2), ("three", 1)] and list(kept) == []


def test_rules_that_reject_more_per_second_come_first():
    import time

    def slow(t):
        time.sleep(0.02)
        return np.ones(len(t), bool)

    rules = (q.Rule("never", lambda t: np.zeros(len(t), bool)), q.Rule("slow", slow), q.Rule("fast", lambda t: np.ones(len(t), bool)))
    assert [r.name for r in q.ordered(pa.array(["a", "b"]), rules)] == ["fast", "slow", "never"]
    assert q.ordered(pa.array([], pa.string()), rules) == rules


def test_the_cost_measured_is_the_cost_paid():
    """A dear feature that is given, or that an earlier rule has computed, costs a later rule nothing."""
    import time

    computed = []

    def dear(t):
        computed.append(len(t))
        time.sleep(0.05)
        return np.arange(len(t))

    sample = pa.array([str(i) for i in range(10)])
    rules = (q.Rule("dear", lambda t: t["dear"] < 6), q.Rule("cheap", lambda t: t["n_words"] > 5))
    quick = q.Rule("quick", lambda t: (time.sleep(0.01), t["n_words"] == 1)[1] & (np.arange(len(t)) < 5))
    q.FEATURES["dear"] = dear
    try:
        assert [r.name for r in q.ordered(sample, (quick, *rules))] == ["quick", "dear", "cheap"]
        assert [r.name for r in q.ordered(sample, (quick, *rules), given=("dear", "n_words"))] == ["dear", "quick", "cheap"]
    finally:
        del q.FEATURES["dear"]


def test_rejections_are_counted_on_what_earlier_rules_left():
    sample = pa.array([str(i) for i in range(100)])
    numbers = lambda t: np.array([int(v.as_py()) for v in t.values])
    rules = (
        q.Rule("many", lambda t: numbers(t) < 60),
        q.Rule("same", lambda t: numbers(t) < 59),  # nothing is left for it
        q.Rule("others", lambda t: numbers(t) > 90),
    )
    assert [r.name for r in q.ordered(sample, rules)][-1] in ("same", "many") and q.ordered(sample, rules)[1].name == "others"


def test_samples_have_their_size(spark):
    from heliovent.llm.sampling import least_hashes

    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"), (F.col("id") % 2).alias("lang"))
    assert least_hashes(rows, 100, []).count() == 100
    assert {r["lang"]: r["count"] for r in least_hashes(rows, 50, ["lang"]).groupBy("lang").count().collect()} == {0: 50, 1: 50}
    assert least_hashes(rows, 10_000, ["lang"]).count() == 3000
    same = rows.withColumn("doc_id", F.lit(1))
    assert least_hashes(same, 100, []).count() == 100
    assert least_hashes(rows.where("false"), 100, []).count() == 0


def test_good_documents_stay(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    judged = [r for r in q.judge_quality(spark.read.parquet(f"{DATA}/documents.parquet")).collect() if r.doc_id in labels]
    assert all(r.kept for r in judged if labels[r.doc_id] and not r.base_failed)
    assert all(not r.kept for r in judged if r.base_failed)
    bad = [r for r in judged if not labels[r.doc_id]]
    assert bad and sum(not r.kept for r in bad) / len(bad) > 0.9


@pytest.mark.parametrize("cases", [[(1, None)], []])
def test_no_text_and_empty_table(spark, cases):
    got = q.judge_quality(spark.createDataFrame(cases, "doc_id long, text string")).collect()
    assert [(r.n_words, r.base_failed, r.kept) for r in got] == [(0, True, False)] * len(cases)
