"""Queries that run as streams over the given tables, in micro-batches, and give what the batch queries give."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import nodes
from ..operators.lineage import scratch
from ..streaming import frontier
from .registry import SQL, query


@query(SQL["frontier_fixpoint"])
def frontier_stream(t, spark):
    """Links arrive in two batches, the seeds between them; reached pages send on."""
    at = scratch(spark, "frontier")
    pages = t("pages").select("page_id", "url", "html")
    links = nodes.anchors(nodes.nodes(pages, "page_id"), "url").select("page_id", "url", F.lit("link").alias("kind"), F.col("link").alias("to"))
    seeds = pages.where(F.contains("url", F.lit("/en/"))).select("url", F.lit("reach").alias("kind"))
    for part in (links.where("page_id % 2 = 0"), seeds, links.where("page_id % 2 = 1")):
        frontier.put(part, f"{at}/inbox")
        frontier.run(spark, f"{at}/inbox", f"{at}/checkpoint", f"{at}/events")
    return frontier.reached(spark, f"{at}/events")


@query(SQL["late_hint_correction"])
def late_hint_stream(t, spark):
    """Events as hints, purchases as visits; they arrive in three batches, not in order of time."""
    at = scratch(spark, "hints")
    e = t("events").select("event_id", F.col("user_id").cast("string").alias("url"), F.col("event_type").alias("hint"), F.col("event_id").alias("seq"))
    visits = e.where("hint = 'purchase'").select("event_id", "url", F.lit("reach").alias("kind"), "seq")
    for k in (2, 0, 1):
        frontier.put(e.where(F.col("event_id") % 3 == k).withColumn("kind", F.lit("hint")), f"{at}/inbox")
        frontier.put(visits.where(F.col("event_id") % 3 == k), f"{at}/inbox")
        frontier.run(spark, f"{at}/inbox", f"{at}/checkpoint", f"{at}/events")
    return frontier.hints(spark, f"{at}/events").select(F.col("url").cast("long").alias("user_id"), "hint")
