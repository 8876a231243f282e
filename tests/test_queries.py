"""Every query against its SQL in DuckDB; those without SQL must give rows."""

import os

import duckdb
import pytest

from docgraph import queries as Q


@pytest.fixture(scope="session")
def db(data):
    c = duckdb.connect()
    for f in os.listdir(data):
        c.execute(f"create view {f[:-8]} as select * from '{data}/{f}'")
    return c


@pytest.mark.parametrize("name", list(Q.queries()))
def test_query(spark, data, db, name):
    df = Q.queries()[name](spark, data)
    columns = sorted(df.columns)
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    if name not in Q.oracle_sql():
        assert got
        return
    result = db.execute(Q.oracle_sql()[name])
    names = [x[0] for x in result.description]
    assert sorted(names) == columns
    assert got == sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in result.fetchall())


def test_entry(spark):
    import __spark_entry__ as E

    assert E.entry(spark).count() > 0
    assert set(E.oracle_sql()) <= set(E.queries())
