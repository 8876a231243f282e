"""Parallel moves over stored edges: against the sequential ones, and how few tables they need."""

import random

import pytest
from pyspark.sql import functions as F

from docgraph.operators import communities

R = random.Random(5)


def planted(groups, size, near, far):
    """Edges of groups that are dense within, and sparse between them."""
    rows = set()
    for g in range(groups):
        for i in range(size):
            rows |= {(f"g{g}n{i:02}", f"g{g}n{R.randrange(size):02}") for _ in range(near)}
            rows |= {(f"g{g}n{i:02}", f"g{R.randrange(groups)}n{R.randrange(size):02}") for _ in range(far)}
    return [(a, b, 1) for a, b in sorted({(min(e), max(e)) for e in rows}) if a != b]


def graph(spark, rows):
    return spark.createDataFrame(rows, "a string, b string, weight long")


def of(df):
    return {(r.id, r.community) for r in df.collect()}


def test_planted_groups(spark):
    pairs = graph(spark, planted(5, 16, 8, 1))
    got, alone = communities.detect(pairs, few=0), communities.detect(pairs)
    assert communities.modularity(pairs, got) >= 0.95 * communities.modularity(pairs, alone) > 0.4
    assert all(r.community == min(r.m) for r in got.groupBy("community").agg(F.collect_set("id").alias("m")).collect())
    assert got.count() == got.select("id").distinct().count() == 80


def test_lone_pairs_do_not_change_places(spark):
    pairs = graph(spark, [(f"a{k:02}", f"b{k:02}", 3) for k in range(24)])
    want = {(f"{x}{k:02}", f"a{k:02}") for k in range(24) for x in "ab"}
    assert of(communities.detect(pairs, few=0)) == want == of(communities.detect(pairs.repartition(3, "b"), few=0))


def test_hubs_are_dealt_to_parts(spark):
    half = spark.createDataFrame([(0, k, 2) for k in range(1, 40)] + [(1, 2, 1)], "id long, near long, weight long")
    held, around = communities.hold(half, 2, bucket=10)
    assert {r.id: r.k for r in around.collect()} == {0: 78, 1: 3, 2: 3} | {k: 2 for k in range(3, 40)}
    assert [(r.hub, r.parts) for r in held.hubs.collect()] == [(0, 4)] and held.rows.where("near = 0").select("part").distinct().count() == 4
    nodes = around.select(F.col("id").alias("near"), (F.col("id") * 2).alias("twice"))
    got = sorted(tuple(r) for r in held.told(nodes).select("id", "near", "weight", "twice").collect())
    assert got == sorted((a, b, w, 2 * b) for x, y, w in ((r.id, r.near, r.weight) for r in half.collect()) for a, b in ((x, y), (y, x)))
    held.drop()


def test_numbers_are_places(spark):
    names, half = communities.numbered(graph(spark, [("d", "b", 1), ("b", "d", 2), ("c", "c", 5), ("a", "b", 1)]).repartition(3))
    assert {r.id: r.number for r in names.collect()} == {"a": 0, "b": 1, "d": 2}
    assert {tuple(r) for r in half.collect()} == {(1, 2, 3), (0, 1, 1)}


@pytest.mark.parametrize("few, most", [(communities.FEW, 12), (0, 60)])
def test_tables_of_a_small_graph(spark, monkeypatch, few, most):
    """Each table is a job that waits: a graph that one task holds takes a few, and each level of others some."""
    made = []
    monkeypatch.setattr(communities, "cut", lambda df, cut=communities.cut: made.append(df) or cut(df))
    communities.detect(graph(spark, planted(3, 8, 4, 1)), few=few).count()
    assert len(made) <= most
