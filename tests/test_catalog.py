"""Every query with a SQL form equals that form; every other one yields rows."""

from __future__ import annotations

import duckdb
import pytest

from catalog.queries import ORACLES, QUERIES
from tests.helpers import rows

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "int": "INTEGER", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, sf, duck, name):
    got = QUERIES[name](spark, sf)
    want = duck.sql(ORACLES[name])
    order = sorted(range(len(want.columns)), key=lambda i: want.columns[i])
    assert sorted(got.columns) == [want.columns[i] for i in order]
    types = dict(zip(want.columns, map(str, want.types)))
    assert {c: TYPES[t] for c, t in got.dtypes} == types
    expected = sorted((tuple(r[i] for i in order) for r in want.fetchall()), key=repr)
    assert rows(got) == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_yields_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
