import pytest

from heliovent.llm import ngram_join as nj
from tests.llm import brute


def expected(rows):
    named = lambda i: None if i == nj.NO_ID else i
    return sorted(((named(i), n, named(c)) for i, n, c in brute.jaccard_components(rows, nj.NO_ID)), key=repr)


def test_components_equal_all_pairs(docs, rows):
    got = sorted(map(tuple, nj.join_documents(docs).collect()), key=repr)
    assert got == expected(rows)


@pytest.mark.parametrize("family", [2, 3])
def test_cut_families_lose_no_link(spark, monkeypatch, family):
    """A chain of texts, each near the next only, a crowd of copies, and texts that share a passage but are not near."""
    monkeypatch.setattr(nj, "FAMILY", family)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for k in range(9):
        rows.append((k, " ".join(f"c{j}" if j < 3 * k else base[j] for j in range(60))))
    rows += [(100 + k, " ".join(["hot"] * 3 + [f"h{i}" for i in range(40)] + [f"x{k}"])) for k in range(8)]
    rows += [(200 + k, " ".join([f"p{i}" for i in range(30)] + [f"own{k}_{i}" for i in range(12)])) for k in range(7)]
    got = sorted(map(tuple, nj.join_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == expected(rows)
    assert len({c for _, _, c in got}) < len(rows)


@pytest.mark.parametrize("common", [44, 46, 47])
def test_templated_texts_that_are_not_near(spark, monkeypatch, common):
    """A boilerplate in all texts, a Jaccard similarity about the threshold, few links: groups stay small, and no link is lost."""
    family = 16
    monkeypatch.setattr(nj, "FAMILY", family)
    real = nj._multiply

    def checked(percent, again):
        inner = real(percent, again)

        def make(table):
            keys = list(zip(*(table[x].to_pylist() for x in ("head", "chunk", "tile"))))
            assert max(keys.count(k) for k in set(keys)) <= 3 * family + 1, "a group of rows is too large"
            return inner(table)

        return make

    monkeypatch.setattr(nj, "_multiply", checked)
    rows = []
    for k in range(150):
        own = [f"v{(k // 2)}_{i}" for i in range(3)] + [f"u{k}_{i}" for i in range(6 + k % 3)]
        rows.append((k, " ".join([f"b{i}" for i in range(common)] + own)))
    rows += [(1000 + k, " ".join([f"b{i}" for i in range(common)] + [f"z{k // 3}_{i}" for i in range(10)] + [f"y{k}"])) for k in range(30)]
    got = sorted(map(tuple, nj.join_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=repr)
    assert got == expected(rows)
    assert 1 < len({c for _, _, c in got}) < len(rows)


def test_one_row_of_each_component_stays(docs):
    kept = nj.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    heads = {r.doc_id for r in nj.join_documents(docs).collect() if r.doc_id == r.component_id}
    assert set(ids) == heads and 900_007 not in ids


def test_empty_table(nothing):
    assert nj.join_documents(nothing).count() == 0
    assert nj.one_of_each(nothing).count() == 0
