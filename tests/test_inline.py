"""Each case of inline.py against the result that is worked out for it."""

import duckdb
import pytest

from . import inline


@pytest.mark.parametrize("name", list(inline.CASES))
def test_case(spark, name):
    df = inline.CASES[name](None, spark)
    columns = sorted(df.columns)
    result = duckdb.execute(inline.SQL[name])
    names = [x[0] for x in result.description]
    assert sorted(names) == columns
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert got == sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in result.fetchall())
