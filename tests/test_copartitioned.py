"""Edges in buckets by their question: the same results as without, and no exchange of edges."""

import re

from pyspark.sql import functions as F

from docgraph.operators import copartitioned, corroborate, graph
from docgraph.operators.resolve import two_pass


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanged(df, column):
    """Exchanges whose input has a column that only edges have."""
    tree = plan(df).split("\n")
    out = []
    for k, line in enumerate(tree):
        if "Exchange hashpartitioning" in line or "Exchange rangepartitioning" in line:
            depth = len(re.match(r"[\s:|+\-*()\d]*", line).group())
            below = []
            for x in tree[k + 1 :]:
                if len(re.match(r"[\s:|+\-*()\d]*", x).group()) <= depth:
                    break
                below.append(x)
            if any(re.search(rf"\b{column}#", x) for x in below):
                out.append(line)
    return out


def edges_of(spark):
    """A third of the rows ask for one name; some names are null, empty, repeated, ambiguous or unknown."""
    name = F.when(F.col("id") % 3 == 0, "N.Hot").when(F.col("id") % 50 == 1, F.lit(None)).when(F.col("id") % 50 == 2, "").otherwise(F.concat(F.lit("X.P"), (F.col("id") % 40).cast("string")))
    return spark.range(3000).select(F.col("id").alias("ord"), name.alias("q"), F.repeat(F.lit("w"), 5).alias("wide"))


def test_resolution_equals_two_passes_and_moves_no_edge(spark):
    known = spark.createDataFrame([("N.Hot", "Hot"), ("A.P1", "P1"), ("A.P2", "P2"), ("B.P2", "P2"), ("X.P3", "P3"), (None, None)], "f string, s string")
    edges = edges_of(spark)
    edges = edges.union(edges.where("ord < 9"))  # repeated rows stay
    stored = copartitioned.by_name(edges, "q", buckets=8)
    got = copartitioned.resolved(stored, "q", known, "f", "s")
    key = lambda df: sorted(map(repr, df.select("ord", "q", "wide", "resolved", "resolved_how").collect()))
    assert key(got) == key(two_pass(edges, "q", known, "f", "s"))
    assert stored.hot.count() == 1 and stored.hot.first().parts == 3  # the hot name alone has more than an eighth
    assert {r.id for r in copartitioned.unknown(stored, "q", known, "f", "s").collect()} == {r.q for r in two_pass(edges, "q", known, "f", "s").where("resolved_how = 'external'").select("q").distinct().collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        again = copartitioned.resolved(stored, "q", known, "f", "s").select("ord", "wide", "resolved", "resolved_how")
        assert "Bucketed: true" in plan(again) and "SortMergeJoin" in plan(again)
        assert not exchanged(again, "wide")
        # without the buckets the same check finds edges on the move
        assert exchanged(two_pass(edges, "q", known, "f", "s").select("wide", "resolved"), "wide")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    stored.drop()
    assert not spark.catalog.tableExists(stored.table)


def test_every_row_of_one_key_and_no_rows(spark):
    known = spark.createDataFrame([("N.A", "A")], "f string, s string")
    one = spark.range(500).select(F.col("id").alias("ord"), F.lit("A").alias("q"))
    stored = copartitioned.by_name(one, "q", buckets=4)
    assert stored.hot.first().parts == 4
    assert copartitioned.resolved(stored, "q", known, "f", "s").groupBy("resolved", "resolved_how").count().collect() == [("N.A", "short_name_fallback", 500)]
    assert copartitioned.resolved(copartitioned.by_name(one.where("false"), "q", buckets=4), "q", known, "f", "s").count() == 0


def test_build_and_edge_results_of_stored_edges(spark, data):
    from docgraph import queries as Q  # noqa: F401
    from docgraph.plans import typed

    t = lambda name: spark.read.parquet(f"{data}/{name}.parquet")
    nodes, edges = typed._nodes_and_edges(t)
    a, b = graph.build(nodes, edges), copartitioned.build(nodes, copartitioned.by_name(edges, "candidate_target_type", buckets=8))
    for x, y in ((a.nodes, b.nodes), (a.edges, b.edges)):
        assert x.columns == y.columns and x.exceptAll(y).isEmpty() and y.exceptAll(x).isEmpty()
    edges, types = typed._overloads(t)
    strange = edges.limit(4).withColumn("source_type", F.when(F.col("ord") % 2 == 0, F.lit(None)).otherwise(""))
    edges = edges.union(strange).union(strange)
    a, b = corroborate.edge_results(edges, types), copartitioned.edge_results(copartitioned.by_question(edges, buckets=8), types)
    assert a.columns == b.columns and a.count() == edges.count() and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
