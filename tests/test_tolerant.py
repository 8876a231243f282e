"""JSON by VARIANT: missing, unfit, unknown and malformed."""

from docgraph.sources.tolerant import Field, malformed, scan

TEXTS = [
    (1, '{"a": 1, "b": "x", "c": [1, {"d": null}], "e": null}'), (2, '﻿[{"a": "2"}, {"b": 5}, 7, null]'), (3, '{"a": "no", "deep": {"x": {"y": 3}}}'), (4, '{"a": 1'), (5, None), (6, "  "), (7, "[]"), (8, '"text"'), (9, '{"a": 1.0, "A": 2, "odd name": true}'), (10, "{}"),
]
FIELDS = [Field("a", "bigint", -1), Field("b", "string"), Field("y", "int", 0, "$.deep.x.y")]


def test_scan(spark):
    df = spark.createDataFrame(TEXTS, "k long, text string")
    got = {(r.k, r.ord): (r.a, r.b, r.y, dict(r.more), list(r.unfit)) for r in scan(df, FIELDS).collect()}
    assert got == {
        (1, 0): (1, "x", 0, {"c": '[1,{"d":null}]', "e": "null"}, []), (2, 0): (2, None, 0, {}, []), (2, 1): (-1, "5", 0, {}, []), (3, 0): (-1, None, 3, {}, ["a"]),
        (9, 0): (1, None, 0, {"A": "2", "odd name": "true"}, []), (10, 0): (-1, None, 0, {}, []),
    }


def test_malformed(spark):
    df = spark.createDataFrame(TEXTS, "k long, text string")
    got = sorted((r.k, r.ord, r.raw, r.why) for r in malformed(df).collect())
    assert [(k, o, w) for k, o, _, w in got] == [(2, 2, "not an object but bigint"), (2, 3, "not an object but void"), (4, 0, "no JSON"), (8, 0, "not an object but string")]
    assert got[2][2] == '{"a": 1'


def test_empty_and_plan(spark):
    df = spark.createDataFrame(TEXTS, "k long, text string").where("k < 0")
    assert scan(df, FIELDS).count() == 0 and malformed(df).count() == 0
