"""The long tail of unknown relations: clusters by member or target name on two overlapping axes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import vocabulary as V


def on_axes(edges: DataFrame) -> DataFrame:
    """The edges of the long tail with axis and key, src and member.

    An edge of unknown type counts on the axis of its type, one that needs validation on that axis too.
    """
    e = edges.withColumn("src", F.coalesce("source_type", F.lit(""))).withColumn("member", F.coalesce("member_name", F.lit("")))
    by_type = e.where(F.col("candidate_edge_type").isin(V.UNKNOWN_EDGES)).select("*", F.col("candidate_edge_type").alias("axis"), F.when(F.col("candidate_edge_type").isin(V.EDGES_BY_MEMBER_NAME), R.member_key(F.col("member"))).otherwise(R.bare_name(F.col("candidate_target_type"))).alias("key"))
    by_need = e.where("edge_confidence = 'needs_runtime_validation'").select("*", F.lit("needs_runtime_validation").alias("axis"), R.bare_name(F.col("candidate_target_type")).alias("key"))
    return by_type.union(by_need)


#: Smallest hashes that a merged sketch keeps, as a power of two: the standard error of an estimate is 1 / sqrt(2**BITS), and up to 2**BITS
#: distinct values are counted exactly.
BITS = 12


def state(edges: DataFrame, bits: int = BITS) -> DataFrame:
    """What a batch of edges adds to its clusters: counts, and sketches of distinct source types and members. States of any batches, in
    any order, become one by merged(); no edge is read again. clusters() counts exactly, from all edges at once.

    These are theta sketches: once merged, one keeps the 2**bits smallest hashes of all distinct values and the next one as its bound,
    so its estimate depends on the values alone. Estimates of HLL sketches depend on how values came into them. Sketches skip empty
    strings, clusters() counts them: hence the sign before each value."""
    rows = on_axes(edges)
    seen = lambda c: F.theta_sketch_agg(F.concat(F.lit("="), c), bits)
    return rows.groupBy("axis", "key").agg(
        F.count("*").alias("count"), seen("src").alias("sources"), seen("member").alias("members"), F.count_if("lookup_referenced").alias("lookup_referenced_count"),
        F.count_if(F.col("dll_verified_status") == "member_not_found").alias("member_not_found_count"), F.min("ord").alias("first"),
    )


def merged(states: DataFrame, bits: int = BITS) -> DataFrame:
    """One state of a union of states; bits: those of the states."""
    return states.groupBy("axis", "key").agg(
        F.sum("count").alias("count"), F.theta_union_agg("sources", bits).alias("sources"), F.theta_union_agg("members", bits).alias("members"), F.sum("lookup_referenced_count").alias("lookup_referenced_count"),
        F.sum("member_not_found_count").alias("member_not_found_count"), F.min("first").alias("first"),
    )


def estimated(states: DataFrame, bits: int = BITS) -> DataFrame:
    """As clusters(), without examples, with estimates for source_types and member_names. A state that was never merged is merged
    with nothing first, so that the estimate depends on the edges alone."""
    m = merged(states, bits)
    return m.select("axis", "key", "count", F.theta_sketch_estimate("sources").alias("source_types"), F.theta_sketch_estimate("members").alias("member_names"), "lookup_referenced_count", "member_not_found_count", "first")


def clusters(edges: DataFrame, examples: int = 5) -> DataFrame:
    """axis, key, count, distinct source types and members, corroborated counts and the first examples, by count."""
    rows = on_axes(edges)
    first = rows.withColumn("place", F.row_number().over(Window.partitionBy("axis", "key").orderBy("ord"))).where(F.col("place") <= examples)
    shown = first.groupBy("axis", "key").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "src", "member"))), lambda x: F.concat_ws(".", x["src"], x["member"])).alias("examples"))
    counted = rows.groupBy("axis", "key").agg(F.count("*").alias("count"), F.countDistinct("src").alias("source_types"), F.countDistinct("member").alias("member_names"), F.count_if("lookup_referenced").alias("lookup_referenced_count"), F.count_if(F.col("dll_verified_status") == "member_not_found").alias("member_not_found_count"), F.min("ord").alias("first"))
    return counted.join(shown, ["axis", "key"]).orderBy("axis", F.desc("count"), "first")


def totals(edges: DataFrame) -> DataFrame:
    """Edges, unknown ones and their share, and those that need validation."""
    t = edges.agg(F.count("*").alias("total"), F.count_if(F.col("candidate_edge_type").isin(V.UNKNOWN_EDGES)).alias("unknown"), F.count_if(F.col("edge_confidence") == "needs_runtime_validation").alias("needs_validation"))
    return t.withColumn("unknown_share", F.bround(R.share(F.col("unknown"), F.col("total")), 4))


def shown(rows: DataFrame, top: int, least: int = 1, count: str = "count", order: str = "first") -> DataFrame:
    """Rows of a count of at least `least`, the `top` largest."""
    return rows.where(F.col(count) >= least).orderBy(F.desc(count), order).limit(top)


def breakdown(rows: DataFrame, key: str, top: int = 15) -> DataFrame:
    """The top keys with count and percent of all, and how many keys there are besides."""
    counts = rows.groupBy(key).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_all"), F.count("*").alias("_keys"))  # one row
    out = counts.crossJoin(F.broadcast(total)).withColumn("percent", 100 * F.col("n") / F.col("_all")).withColumn("more", F.greatest(F.col("_keys") - top, F.lit(0)))
    return out.drop("_all", "_keys").orderBy(F.desc("n"), key).limit(top)


def by_confidence(edges: DataFrame, k: int = 25, certain: bool = True) -> DataFrame:
    """The k most (or least) certain edges, unknown types behind the others, stable by ord."""
    unknown = F.col("candidate_edge_type").isin(V.UNKNOWN_EDGES)
    rank = R.rank(F.col("edge_confidence"))
    return edges.orderBy(*([unknown, rank] if certain else [rank.desc()]), "ord").limit(k)
