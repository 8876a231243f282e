"""Edges stored by the question they ask, so that lookups come to them and no edge is shuffled again.

What a lookup says of an edge depends on a few of its columns: how its target resolves on the name alone, which overload
it means on type, member and signature. store() writes the rows once, in buckets by that key. keys() gives each key once,
which the rows of a bucket tell without an exchange of rows; the joins then run over keys, and told() brings their results to
the buckets: only the results move, however many lookups made them.

A key with more than its share of the rows (rows / buckets) is dealt to parts of about that share, and its result is
repeated for each part. There are fewer such keys than buckets and at most twice as many parts, so the list of them may be broadcast.
Null is a key like others. The parts follow from a column that tells rows apart, so that a repeated task deals alike.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from . import corroborate, graph
from .lineage import cut, scratch
from .resolve import two_pass

KEY, PART = "_stored_key", "_stored_part"


@dataclass
class Stored:
    """rows: the bucketed table, with KEY and PART; hot: (_hot, parts) of the keys that are dealt to parts."""

    rows: DataFrame
    hot: DataFrame
    table: str

    def keys(self, *columns: str) -> DataFrame:
        """KEY and columns that follow from it, each key once: a bucket gives each of its keys on, not its rows."""
        return self.rows.select(KEY, *columns).distinct()

    def told(self, results: DataFrame) -> DataFrame:
        """The rows with the columns of results (one row for each KEY); null where there is none."""
        dealt = results.join(F.broadcast(self.hot), F.col(KEY) == F.col("_hot"), "left").withColumn(PART, F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("_hot", "parts")
        return self.rows.join(dealt, [KEY, PART], "left").drop(KEY, PART)

    def drop(self) -> None:
        self.rows.sparkSession.sql(f"DROP TABLE IF EXISTS {self.table}")


def store(rows: DataFrame, key: Column, spread: str, buckets: int = 200) -> Stored:
    """rows in `buckets` buckets by key, a string; spread: a column that tells rows of a key apart. Buckets should have
    some hundred MB each.

    The table lies in the shared folder, is known to the session's catalog, and is deleted when the driver ends or by drop().
    """
    spark = rows.sparkSession
    text = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("null"))
    keyed = rows.withColumn(KEY, text(key))
    size = cut(keyed.groupBy(KEY).count())
    share = max(1, -(-(size.agg(F.sum("count")).first()[0] or 0) // buckets))
    hot = cut(size.where(F.col("count") > share).select(F.col(KEY).alias("_hot"), F.ceil(F.col("count") / share).cast("int").alias("parts")))
    dealt = keyed.join(F.broadcast(hot), F.col(KEY) == F.col("_hot"), "left")
    part = F.when(F.col("parts").isNotNull(), F.pmod(F.xxhash64(spread), F.col("parts")).cast("int")).otherwise(0)
    dealt = dealt.withColumn(PART, part).drop("_hot", "parts")
    name = f"stored_{uuid.uuid4().hex}"
    dealt.repartition(buckets, KEY, PART).write.option("path", scratch(spark, "stored")).bucketBy(buckets, KEY, PART).sortBy(KEY, PART).saveAsTable(name)
    return Stored(spark.table(name), hot, name)


def by_name(edges: DataFrame, name: str, spread: str = "ord", buckets: int = 200) -> Stored:
    return store(edges, F.col(name), spread, buckets)


def resolved(edges: Stored, name: str, known: DataFrame, full: str, short: str, *, allow_short: bool = True, dotted: bool = False, as_: str = "resolved") -> DataFrame:
    """resolve.two_pass() of edges that by_name() has stored: both of its joins run over names."""
    asked = edges.keys(name)
    found = two_pass(asked, name, known, full, short, allow_short=allow_short, dotted=dotted, as_=as_)
    return edges.told(found.select(KEY, as_, f"{as_}_how"))


def unknown(edges: Stored, name: str, known: DataFrame, full: str, short: str) -> DataFrame:
    """id and short_name of the stubs that targets need: names that do not resolve."""
    found = two_pass(edges.keys(name), name, known, full, short, as_="t")
    return found.where("t_how = 'external'").select(F.col(name).alias("id"), R.short_name(F.col(name)).alias("short_name"))


def build(nodes: DataFrame, edges: Stored) -> graph.Graph:
    """graph.build() of edges that by_name(edges, "candidate_target_type") has stored."""
    return graph.typed(nodes, resolved(edges, "candidate_target_type", nodes, "full_type_name", "short_name", as_="t"))


def by_question(edges: DataFrame, spread: str = "ord", buckets: int = 200) -> Stored:
    return store(edges.withColumn("signature", corroborate.signature()), corroborate.question(), spread, buckets)


def edge_results(edges: Stored, types: DataFrame) -> DataFrame:
    """corroborate.edge_results() of edges that by_question() has stored."""
    asked = edges.keys("source_type", "member_name", "member_kind", "signature").where(F.coalesce("source_type", F.lit("")) != "")
    told = edges.told(corroborate.answers(asked, types, KEY))
    return corroborate.with_answers(told, [c for c in edges.rows.columns if c not in (KEY, PART, "signature")])
