import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from heliovent.llm import exact_dedup as ed
from tests.llm import brute


def expected(rows, best):
    groups = defaultdict(list)
    for i, text in rows:
        groups[brute.lower(text or "")].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = best(known) if known else None
        kept = [True] + [False] * (ids.count(keep) - 1)
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), kept.pop(0) if i == keep else False, sha) for i in ids]
    return sorted(out, key=repr)


@pytest.mark.parametrize(("keep", "best"), [("largest", max), ("smallest", min)])
def test_groups_equal_plain_loops(docs, rows, keep, best):
    assert sorted(map(tuple, ed.copies(docs, keep).collect()), key=repr) == expected(rows, best)


@pytest.mark.parametrize("chunk", [1, 300])
def test_small_chunks(spark, monkeypatch, chunk):
    """Equal texts in many chunks, prefixes of each other, letters beyond ASCII that lower-casing must leave alone."""
    monkeypatch.setattr(ed, "CHUNK", chunk)  # reaches the function below, which runs here
    rows = [(i, t) for i, t in enumerate(["a", "A", "", None, "ab", "É", "é", "a" * 400, "A" * 400, "b"] * 7)]
    import pyarrow as pa

    schema = pa.schema(ed._ENTRY)
    batch = pa.RecordBatch.from_pylist([{"doc_id": i, "text": t} for i, t in rows])
    monkeypatch.setattr(ed.TaskContext, "get", lambda: type("Task", (), {"partitionId": staticmethod(lambda: 3)}))
    entries = [e for b in ed._chunks(schema)([batch]) for e in b.to_pylist()]
    assert len({(e["chunk"], e["place"]) for e in entries}) == len(entries) and len({e["chunk"] for e in entries}) > 1
    entries = sorted(({**e, "n": len(e["ids"])} for e in entries), key=lambda e: (e["content"], -e["best"]))
    table = pa.Table.from_pylist(entries, schema=schema.append(pa.field("n", pa.int64())))
    answers = {(a["chunk"], a["place"]): a for b in ed._neighbours(table.to_batches(max_chunksize=3)) for a in b.to_pylist()}
    got = []
    for e in entries:
        a = answers[e["chunk"], e["place"]]
        got += [(i, a["keep_id"], a["group_size"], a["stays"] and k == 0, a["text_sha256"]) for k, i in enumerate(e["ids"])]
    assert sorted(got, key=repr) == expected(rows, max)


def test_a_third_of_all_rows_are_equal(spark):
    rows = [(i, "the same text everywhere" if i % 3 else f"text {i}") for i in range(9_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(32)
    assert sorted(map(tuple, ed.copies(frame, "largest").collect()), key=repr) == expected(rows, max)


def test_rows_keep_their_columns(docs, rows):
    got = ed.unique_rows(docs)
    assert got.columns == docs.columns and dict(got.dtypes) == dict(docs.dtypes)
    want = sorted(repr(brute.lower(t or "")) for i, t in {brute.lower(t or ""): (i, t) for i, t in rows}.values())
    found = got.select("doc_id", "text").collect()
    assert sorted(repr(brute.lower(r.text or "")) for r in found) == want
    keep = {(k, h) for _, k, _, _, h in expected(rows, min)}
    assert {(r.doc_id, hashlib.sha256(brute.lower(r.text or "").encode()).hexdigest()) for r in found} == keep


def test_empty_table(nothing):
    assert ed.copies(nothing).count() == 0
    assert ed.unique_rows(nothing).count() == 0


def test_content_is_dealt_by_sampled_ranges(docs):
    plan = ed._sorted_groups(docs, "largest", False)[1]._jdf.queryExecution().toString()
    assert "rangepartitioning(" in plan
    assert "Sort [content" in plan


def test_a_common_beginning(spark):
    rows = [(i, "the same first words of every text, " * 3 + str(i % 500)) for i in range(3_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(16)
    assert sorted(map(tuple, ed.copies(frame, "largest").collect()), key=repr) == expected(rows, max)
    entries = ed._sorted_groups(frame, "largest", False)[1]
    assert entries.withColumn("part", F.spark_partition_id()).select("part").distinct().count() > 4
