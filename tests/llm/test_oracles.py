"""Queries of this subpackage against their SQL in DuckDB, over whole tables."""

import pytest

from heliovent.llm.oracles import ORACLES
from heliovent.llm.queries import QUERIES
from tests.llm.conftest import DATA

TYPES = {"bigint": "BIGINT", "boolean": "BOOLEAN", "string": "VARCHAR"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    got = QUERIES[name](spark, DATA)
    want = con.sql(ORACLES[name])
    assert {n: TYPES[t] for n, t in got.dtypes} == dict(zip(want.columns, map(str, want.types)))
    names = sorted(got.columns)
    rows = con.sql(f"SELECT {', '.join(names)} FROM ({ORACLES[name]})").fetchall()
    assert sorted(tuple(r) for r in got.select(*names).collect()) == sorted(rows)


def test_names():
    assert len(QUERIES) == 13 and all(name.split("_")[0] == f"op{n}" for n, name in enumerate(QUERIES, 1))
