"""Queries by name, each with the SQL of the same result where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (t, spark) -> DataFrame under its name; t(name) is a table."""

    def put(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return f(lambda name: spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark)

        QUERIES[f.__name__] = run
        if sql:
            SQL[f.__name__] = sql
        return f

    return put


def sql_keyword(name: str) -> str:
    """CASE arms of the member-name rules for DuckDB, as (edge type, target, rule) columns of a name."""
    from ..functions import vocabulary as V

    def test(kind, words):
        how = {"contains": "contains(lower({n}), '{w}')", "prefix": "starts_with(lower({n}), '{w}')", "suffix": "ends_with(lower({n}), '{w}')", "exact": "lower({n}) = '{w}'"}[kind]
        return "(" + " OR ".join(how.format(n=name, w=w.lower()) for w in words) + ")"

    return "CASE " + " ".join(f"WHEN {test(k, ws)} THEN {i}" for i, (k, ws, _, _) in enumerate(V.KEYWORDS)) + " END"


def sql_values(rows: list[tuple], names: str) -> str:
    """A VALUES table; None is NULL."""
    lit = lambda v: "NULL" if v is None else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return "(VALUES " + ", ".join("(" + ", ".join(map(lit, r)) + ")" for r in rows) + f") AS v({names})"
