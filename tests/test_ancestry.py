"""Intervals of forests and nearest ancestors, against walks up."""

import random

from pyspark.sql import functions as F

from docgraph.operators import ancestry

R = random.Random(9)


def forest(spark, parent):
    return ancestry.tour(spark.createDataFrame(list(parent.items()), "id string, parent string"))


def up(parent, x):
    out = [x]
    while parent.get(out[-1]) in parent:
        out.append(parent[out[-1]])
    return out


def check(parent, rows):
    rows = {r.id: r for r in rows}
    assert set(rows) == set(parent)
    for x in parent:
        line = up(parent, x)
        assert rows[x].depth == len(line) - 1 and rows[x].root == line[-1]
        above = {y for y in parent if rows[y].root == rows[x].root and rows[y].pre <= rows[x].pre <= rows[y].post}
        assert above == set(line)


def test_random_forest_and_a_long_chain(spark):
    parent = {f"n{k:03}": f"n{R.randint(0, k - 1):03}" if k and R.random() < 0.93 else R.choice([None, "outside"]) for k in range(120)}
    check(parent, forest(spark, parent).collect())
    line = {f"c{k:03}": f"c{k - 1:03}" if k else None for k in range(70)}
    check(line, forest(spark, line).collect())


def test_cycles_have_no_root(spark):
    parent = {"a": "b", "b": "a", "below": "a", "own": "own", "x": None, "y": "x"}
    assert sorted(r.id for r in forest(spark, parent).collect()) == ["x", "y"]
    assert ancestry.tour(spark.createDataFrame([], "id string, parent string")).count() == 0


def test_nearest(spark):
    parent = {f"n{k:02}": f"n{R.randint(0, k - 1):02}" if k else None for k in range(60)}
    place = forest(spark, parent).cache()
    has = {(x, m) for x in parent for m in "abc" if R.random() < 0.25}
    holders = spark.createDataFrame(sorted(has), "id string, m string").join(place, "id").select("root", "pre", "post", "m", F.col("id").alias("who"))
    points = place.select("id", "root", "pre").crossJoin(spark.createDataFrame([("a",), ("b",), ("z",)], "m string"))
    got = {(r.id, r.m): r.found.who if r.found else None for r in ancestry.nearest(points, holders, ["m"], ["who"]).collect()}
    assert got == {(x, m): next((y for y in up(parent, x) if (y, m) in has), None) for x in parent for m in "abz"}
