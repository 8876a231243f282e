"""Role aggregation: edges between types as weighted triples of roles and relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import vocabulary as V


def role_order(column: str):
    """Fixed order of the roles, other values behind them."""
    at = F.array_position(F.array(*map(F.lit, V.ROLES)), F.col(column))
    return F.when(at > 0, at).otherwise(len(V.ROLES) + 1)


def with_roles(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Edges both of whose ends are nodes, with source_role, target_role and family."""
    n = nodes.select("id", R.role(F.coalesce(F.nullif("short_name", F.lit("")), R.short_name(F.col("id"))), F.col("base_type"), F.col("class_role")).alias("role"))
    s, t = n.select(F.col("id").alias("source"), F.col("role").alias("source_role")), n.select(F.col("id").alias("target"), F.col("role").alias("target_role"))
    return edges.join(s, "source").join(t, "target").withColumn("family", R.family(F.col("edge_type")))


def top_relations(rows: DataFrame, k: int | None = 12, relation: str = "edge_type", order: str = "ord") -> DataFrame:
    """The k commonest relations, earlier first occurrence first among equals; None or 0 for all."""
    counts = rows.groupBy(relation).agg(F.count("*").alias("n"), F.min(order).alias("first")).orderBy(F.desc("n"), "first")
    return counts.limit(k) if k else counts


def sums(rows: DataFrame) -> DataFrame:
    """Weights of triples, (source, relation) cells and the three single axes, in one pass."""
    s, r, t = F.col("source_role"), F.col("edge_type"), F.col("target_role")
    return rows.groupingSets([[s, r, t], [s, r], [s], [t], [r]], s, r, t).agg(F.count("*").alias("weight"), F.grouping_id().alias("level"))


def triples(rows: DataFrame, least: int = 1) -> DataFrame:
    return rows.groupBy("source_role", "edge_type", "target_role").agg(F.count("*").alias("weight")).where(F.col("weight") >= least).orderBy(F.desc("weight"), "source_role", "edge_type", "target_role")


def examples(rows: DataFrame, keys: list[str], most: int = 80, order: str = "ord") -> DataFrame:
    """The first `most` rows of each key. Only these are kept, so a hot key costs a top-k and no long list."""
    w = Window.partitionBy(*keys).orderBy(order)
    return rows.withColumn("place", F.row_number().over(w)).where(F.col("place") <= most)


def relationship_map(nodes: DataFrame, edges: DataFrame, k: int | None = 12, least: int = 1, most: int = 80) -> dict[str, DataFrame]:
    """triples, heatmap, roles, relations and drilldown of a graph; `included` of `total` edges are of the top relations."""
    rows = with_roles(nodes, edges)
    top = top_relations(rows, k)
    kept = rows.join(top.select("edge_type"), "edge_type", "left_semi")
    heat = kept.groupBy("source_role", "edge_type").agg(F.count("*").alias("weight"))
    heat = heat.join(top.select("edge_type", F.col("n").alias("rn"), "first"), "edge_type").orderBy(role_order("source_role"), F.desc("rn"), "first").drop("rn", "first")
    role_counts = kept.select(F.col("source_role").alias("role"), F.lit(1).alias("s"), F.lit(0).alias("t")).union(kept.select("target_role", F.lit(0), F.lit(1))).groupBy("role").agg(F.sum("s").alias("as_source"), F.sum("t").alias("as_target"))
    disclosed = rows.agg(F.count("*").alias("total")).crossJoin(kept.agg(F.count("*").alias("included")))
    return {"triples": triples(kept, least), "heatmap": heat, "roles": role_counts.orderBy(role_order("role"), "role"), "relations": top, "drilldown": examples(kept, ["source_role", "edge_type", "target_role"], most), "disclosed": disclosed}
