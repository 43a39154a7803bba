import numpy as np
import pytest

from heliovent.llm import embedding_dedup as ed
from tests.llm.brute import Groups
from tests.llm.conftest import DATA

SCHEMA = "vec_id long, embedding array<float>, label int"
NAN, INF = float("nan"), float("inf")


def expected(rows, least=0.98):
    groups, links, by = Groups(), [0] * len(rows), {}
    for k, (_, v, label) in enumerate(rows):
        if v and label is not None and all(x is not None and np.isfinite(x) for x in v) and any(v):
            by.setdefault((label, len(v)), []).append(k)
    ids = [ed.NO_ID if i is None else i for i, _, _ in rows]
    for own in by.values():
        x = np.array([np.array(rows[k][1], np.float32) for k in own], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= least, 1))):
            links[own[a]] += 1
            links[own[b]] += 1
            groups.join(ids[own[a]], ids[own[b]])
    out = []
    for i, n in zip(ids, links):
        c = groups.find(i)
        out.append((None if i == ed.NO_ID else i, n, None if c == ed.NO_ID else c, c == i))
    return sorted(out, key=repr)


def odd():
    return [
        (1, None, 1), (2, [0.0] * 4, 1), (3, [NAN] * 4, 1), (4, [None] * 4, 1), (5, [], 1), (6, [1.0, 2.0], None), (7, [1.0, 2.0], 1),
        (8, [2.0, 4.0], 1), (9, [1.0, 2.0], 2), (None, [1.0, 2.0], 1), (10, [INF, 1.0], 1), (11, [-1.0, -2.0], 1), (12, [1.0, 2.0, 0.0], 1),
        (13, [1.0, 2.0], 1), (13, [1.0, 2.0], 1), (13, [5.0, -1.0], 1), (14, [5.0, -1.1], 1), (15, [1e30, 2e30], 1), (16, [1e-30, 2e-30], 1),
    ]


def near(n):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 8))
    rows = []
    for k in range(n):
        v = centres[k % 12] + rng.normal(size=8) * rng.choice([0.01, 0.1, 0.25])
        rows.append((1000 + k, v.astype(np.float32).tolist(), int(k % 3 == 0)))
    return rows + [(5000 + k, rows[0][1], 0) for k in range(20)]


@pytest.mark.parametrize(("cell", "tile"), [(4096, 4096), (25, 4096), (25, 16)])
def test_links_and_components_equal_all_pairs(spark, monkeypatch, cell, tile):
    monkeypatch.setattr(ed, "CELL", cell)
    monkeypatch.setattr(ed, "TILE", tile)
    rows = odd() + near(240)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS rep", "1 AS cell", "2 AS n", "3 AS weight", "4 AS component")
    assert sorted(map(tuple, ed.join_vectors(frame).collect()), key=repr) == expected(rows)


def test_whole_table(spark):
    table = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, ed.join_vectors(table).collect()), key=repr) == expected(rows)


def test_empty_table(spark):
    assert ed.join_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
