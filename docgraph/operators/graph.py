"""Candidates to a typed graph: resolved endpoints, external stubs, tiers, the core, projections, metadata."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from .resolve import two_pass

CARRIED = ["dll_signature_verified", "dll_relationship_scope", "dll_semantic_verified", "dll_verified_status", "lookup_referenced", "lookup_requires_document_context"]


@dataclass
class Graph:
    nodes: DataFrame
    edges: DataFrame

    def resolution_counts(self) -> DataFrame:
        return self.edges.groupBy("target_resolution").count()

    def external_count(self) -> DataFrame:
        return self.nodes.agg(F.count_if("external").alias("external_nodes"))


def stubs(ends: DataFrame, known: DataFrame, id_: str = "id", full: str = "full_type_name") -> DataFrame:
    """Distinct ids of ends that no known row has."""
    return ends.where(F.coalesce(id_, F.lit("")) != "").select(id_).distinct().join(known.select(F.col(full).alias(id_)), id_, "left_anti")


def free_name(df: DataFrame, name: str) -> str:
    """A name like `name` that no column of df has."""
    taken = {c.lower() for c in df.columns}
    return next(x for k in range(len(taken) + 1) if (x := f"{name}{k or ''}") not in taken)


def build(nodes: DataFrame, edges: DataFrame) -> Graph:
    """Resolves the ends of every edge. A source never takes another type's short name, so it resolves to itself or not at
    all, and its name stays; a target is looked up in two passes. What is unknown gets a stub node."""
    return typed(nodes, two_pass(edges, "candidate_target_type", nodes, "full_type_name", "short_name", as_="t"))


def typed(nodes: DataFrame, e: DataFrame) -> Graph:
    """The graph of edges whose targets are resolved (t, t_how)."""
    e = e.withColumn("target", F.when(F.col("t_how") == "none", None).otherwise(F.coalesce("t", "candidate_target_type")))
    e = e.select(
        "ord", F.col("source_type").alias("source"), "target", "member_name", "member_kind", F.col("candidate_edge_type").alias("edge_type"), F.col("edge_confidence").alias("confidence"),
        R.tier(F.col("edge_confidence"), F.col("candidate_edge_type")).alias("confidence_tier"), F.col("t_how").alias("target_resolution"), "evidence", "source_url", *CARRIED,
    )
    known = nodes.select(F.col("full_type_name").alias("id"), "short_name", F.lit(False).alias("external"), "kind", "namespace", "class_role", "is_element_candidate", "base_type", "source_url", "dll_type_verified")
    ends = e.select(F.col("source").alias("id")).union(e.select("target"))
    outside = stubs(ends, nodes).select("id", R.short_name(F.col("id")).alias("short_name"), F.lit(True).alias("external"))
    return Graph(known.unionByName(outside, allowMissingColumns=True), e)


def core(g: Graph) -> Graph:
    """Edges of the core tier with a target, and the nodes at their ends."""
    e = g.edges.where("confidence_tier = 'core' and target is not null")
    ends = e.select(F.col("source").alias("id")).union(e.select("target"))
    return Graph(g.nodes.join(ends, "id", "left_semi"), e)


def projection(nodes: DataFrame, edges: DataFrame, inside: bool = False) -> DataFrame:
    """Undirected edges a < b with their multiplicity and first place; loops, nulls and foreign ends are left out.

    inside: all ends are known to be nodes, as those of build() and core() are, and need not be looked up again.
    """
    e = edges.where("source <> target")
    if not inside:
        ids = nodes.select("id").distinct()
        e = e.join(ids.select(F.col("id").alias("source")), "source", "left_semi").join(ids.select(F.col("id").alias("target")), "target", "left_semi")
    return e.groupBy(F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b")).agg(F.count("*").alias("weight"), F.min("ord").alias("first"))


def degrees(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("id"), "weight").union(pairs.select("b", "weight")).groupBy("id").agg(F.sum("weight").alias("degree"))


def ends_count(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """How many edge ends each node is, loops counted twice, for labels; inspected degree counts a loop once."""
    ends = edges.select(F.col("source").alias("id"), F.lit(1).alias("once")).union(edges.select("target", (~F.coalesce(F.col("source") == F.col("target"), F.lit(False))).cast("int")))
    return nodes.select("id").join(ends.where("id is not null"), "id").groupBy("id").agg(F.count("*").alias("ends"), F.sum("once").alias("degree"))


def metadata(g: Graph) -> DataFrame:
    """(axis, value, n) of the nodes and edges given: totals and four histograms in one scan each; null is not_checked."""
    label = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("not_checked")).alias(c)
    axes = ["edge_type", "confidence_tier", "dll_verified_status", "lookup_referenced"]
    e = g.edges.select(*map(label, axes)).groupingSets([[F.col(a)] for a in axes] + [[]], *map(F.col, axes)).agg(F.count("*").alias("n"), F.grouping_id().alias("gid"))
    # bit i of the grouping id, from the left, is 0 where axis i is grouped by
    ids = {(1 << len(axes)) - 1 - (1 << len(axes) - 1 - i): a for i, a in enumerate(axes)}
    axis = R.first_match([(F.col("gid") == k, F.lit(a)) for k, a in ids.items()], F.lit("edges"))
    value = F.coalesce(*axes, F.lit("total"))
    totals = g.nodes.agg(F.count("*").alias("nodes"), F.count_if("external").alias("external_nodes")).select(F.expr("stack(2, 'nodes', nodes, 'external_nodes', external_nodes) as (axis, n)"))
    return e.select(axis.alias("axis"), value.alias("value"), "n").union(totals.select("axis", F.lit("total"), "n"))
