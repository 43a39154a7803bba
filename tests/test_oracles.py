"""Every query against its SQL in DuckDB, over whole tables."""

import datetime
import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry_points
from catalogue.oracles import ORACLES
from catalogue.queries import QUERIES

SF_DIR = Path("/root/testdata/sf0.001")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    yield con
    con.close()


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float) and math.isnan(value):
        return (1, "nan")
    if isinstance(value, datetime.date):
        return (2, value.isoformat())
    return (2, repr(value))


def _sorted(rows):
    return sorted(tuple(_key(v) for v in row) for row in rows)


def test_every_query_of_the_catalogue_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries()) and set(ORACLES) <= set(entry_points.oracle_sql())


DUCK_TYPES = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE", "boolean": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    result = QUERIES[name](spark, str(SF_DIR))
    sql = ORACLES[name]
    expected = duck.sql(sql)
    assert sorted((n, DUCK_TYPES.get(t, t)) for n, t in result.dtypes) == sorted(zip(expected.columns, map(str, expected.types)))
    names = sorted(result.columns)
    actual_rows = result.select(*names).collect()
    expected_rows = duck.sql(f"SELECT {', '.join(names)} FROM ({sql})").fetchall()
    assert len(actual_rows) > 0
    assert _sorted(actual_rows) == _sorted(expected_rows)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
