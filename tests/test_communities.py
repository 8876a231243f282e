"""Parallel communities: colours, moves, levels, and against the sequential moves."""

import random

from pyspark.sql import functions as F

from docgraph.operators import communities, community

R = random.Random(3)


def pairs_of(spark, rows):
    return spark.createDataFrame([(a, b, w) for a, b, w in rows], "a string, b string, weight long")


def groups(assigned):
    return {frozenset(r.m) for r in assigned.groupBy("community").agg(F.collect_set("id").alias("m")).collect()}


def cliques(sizes):
    out, last = [], None
    for k, n in enumerate(sizes):
        names = [f"c{k}n{i:02}" for i in range(n)]
        out += [(x, y, 1) for i, x in enumerate(names) for y in names[i + 1 :]]
        if last:
            out.append((last, names[0], 1))
        last = names[-1]
    return out


def test_colours(spark):
    rows = [(f"n{R.randint(0, 40)}", f"n{R.randint(0, 40)}", 1) for _ in range(150)] + cliques([6])
    both = communities.both_ways(pairs_of(spark, rows))
    got = {r.id: r.colour for r in communities.colours(both, None).collect()}
    assert set(got) == {x for a, b, _ in rows for x in (a, b) if a != b}
    assert all(got[a] != got[b] for a, b, _ in rows if a != b)
    bounded = {r.id: r.colour for r in communities.colours(both, 2, 3).collect()}
    assert set(bounded) == set(got) and max(bounded.values()) <= 4
    assert all(bounded[a] != bounded[b] for a, b, _ in rows if a != b and min(bounded[a], bounded[b]) < 2)


def test_cliques_on_a_chain(spark):
    rows = cliques([5, 6, 7])
    got = communities.detect(pairs_of(spark, rows))
    assert groups(got) == {frozenset(f"c{k}n{i:02}" for i in range(n)) for k, n in enumerate((5, 6, 7))}
    assert all(r.community == min(r.m) for r in got.groupBy("community").agg(F.collect_set("id").alias("m")).collect())
    assert {frozenset(x for x in seq if seq[x] == c) for seq in [community.local_moves(rows)] for c in set(seq.values())} == groups(got)


def test_weights_loops_parallel_edges_and_no_edges(spark):
    rows = [("a", "b", 5), ("b", "a", 4), ("a", "a", 90), ("c", "d", 9), ("b", "c", 1)]
    assert groups(communities.detect(pairs_of(spark, rows))) == {frozenset("ab"), frozenset("cd")}
    assert communities.detect(pairs_of(spark, rows).where("false")).count() == 0
    assert communities.detect(pairs_of(spark, [("a", "a", 3)])).count() == 0


def test_against_sequential_moves(spark):
    """Planted groups in a random graph, from another partitioning."""
    rows = {}
    for _ in range(160):
        a, b = R.randint(0, 29), R.randint(0, 29)
        if a != b and (a % 4 == b % 4 or R.random() < 0.1):
            rows[f"v{min(a, b):02}", f"v{max(a, b):02}"] = R.randint(1, 3)
    rows = [(a, b, w) for (a, b), w in sorted(rows.items())]
    pairs = pairs_of(spark, rows).repartition(3, "b")
    got = communities.detect(pairs)
    seq = spark.createDataFrame(list(community.local_moves(rows).items()), "id string, community long")
    assert communities.modularity(pairs, got) >= 0.95 * communities.modularity(pairs, seq)
