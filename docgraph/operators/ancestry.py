"""Ancestors in forests by intervals: an Euler tour ranked by doubling, and lookups of the nearest ancestor that holds something.

A tour goes down to each node and up from it, so x is at or below y where pre(y) <= pre(x) <= post(y). The places of
the tour's arcs are found by list ranking: every arc knows the next one; in each round it takes over what the one it points to knows, and
points twice as far. A forest of any depth takes as many rounds as the length of its longest tour has bits.

The nearest ancestor with some property is the innermost of the intervals of all nodes that have it. Intervals of a forest never cross,
so a running count of those that are open tells which: the last one that opened at this count. Two windows do it, and
neither rows nor holders are multiplied by the depth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut


def tour(parents: DataFrame) -> DataFrame:
    """id, root, pre, post and depth (0 for roots) of a forest (id, parent), each id once.

    A parent that is null or no id makes a root. pre and post count within the tree of a root, whose name tells trees apart.
    Nodes on a cycle, and below one, have no root and are not returned.
    """
    ids = parents.select(F.col("id").alias("parent"), F.lit(True).alias("known"))
    p = cut(parents.join(ids, "parent", "left").select("id", F.when(F.col("known"), F.col("parent")).alias("parent")))
    among = p.where("parent is not null").withColumn("sibling", F.lead("id").over(Window.partitionBy("parent").orderBy("id")))
    first = among.groupBy(F.col("parent").alias("id")).agg(F.min("id").alias("child"))
    links = p.join(among.select("id", "sibling"), "id", "left").join(first, "id", "left")
    arc = lambda id_, up: F.struct(id_.alias("id"), F.lit(up).alias("up"))
    down = links.select(arc(F.col("id"), False).alias("arc"), F.when(F.col("child").isNotNull(), arc(F.col("child"), False)).otherwise(arc(F.col("id"), True)).alias("next"))
    up = links.select(arc(F.col("id"), True).alias("arc"), F.when(F.col("sibling").isNotNull(), arc(F.col("sibling"), False)).when(F.col("parent").isNotNull(), arc(F.col("parent"), True)).alias("next"))
    # behind: arcs from this one to where it points; rise: how far these go up, less how far down
    step = F.when(F.col("next").isNull(), 0).when(F.col("next.up"), 1).otherwise(-1).cast("long")
    ranked = cut(down.union(up).select("arc", "next", F.when(F.col("next").isNull(), 0).otherwise(1).cast("long").alias("behind"), step.alias("rise"), F.coalesce("next", "arc").alias("last")))
    n = ranked.count()
    for _ in range(n.bit_length() + 1):
        if ranked.where("next is not null").isEmpty():
            break
        on = ranked.select(F.col("arc").alias("next"), F.col("next").alias("_next"), F.col("behind").alias("_behind"), F.col("rise").alias("_rise"), F.col("last").alias("_last"))
        open_ = ranked.where("next is not null").join(on, "next").select("arc", F.col("_next").alias("next"), (F.col("behind") + F.col("_behind")).alias("behind"), (F.col("rise") + F.col("_rise")).alias("rise"), F.col("_last").alias("last"))
        ranked = cut(open_.union(ranked.where("next is null")))
    whole = ranked.where("next is null").select("arc.id", "arc.up", F.col("last.id").alias("root"), "behind", "rise")
    # the tour of a root ends with the way up from it; its length is what lies behind the way down to it
    size = whole.where("id = root and not up").select("root", F.col("behind").alias("length"))
    at = whole.join(size, "root").withColumn("place", F.col("length") - F.col("behind"))
    of = at.groupBy("id", "root").agg(F.min("place").alias("pre"), F.max("place").alias("post"), F.min_by("rise", "place").alias("rise"))
    return of.select("id", "root", "pre", "post", (F.col("rise") - 1).alias("depth"))


def nearest(points: DataFrame, holders: DataFrame, by: list[str], carry: list[str]) -> DataFrame:
    """points with `found`, the pre and the carried columns of the innermost holder at or above them that agrees in `by`.

    points: root and pre of nodes with any other columns; holders: root, pre, post, `by` and carried columns, at most one for each node
    and `by`. Nothing is found where there is none.
    """
    keys, others = ["root", *by], [c for c in points.columns if c not in ("root", "pre", *by)]
    value = F.struct("pre", *carry)
    kept = F.struct(*others) if others else F.struct(F.lit(0).alias("_"))
    opens = holders.select(*keys, "pre", F.lit(0).alias("kind"), F.lit(1).alias("step"), value.alias("value"))
    ends = holders.select(*keys, F.col("post").alias("pre"), F.lit(2).alias("kind"), F.lit(-1).alias("step"))
    asked = points.select(*keys, "pre", F.lit(1).alias("kind"), F.lit(0).alias("step"), kept.alias("kept"))
    rows = opens.unionByName(ends, allowMissingColumns=True).unionByName(asked, allowMissingColumns=True)
    rows = rows.withColumn("open", F.sum("step").over(Window.partitionBy(*keys).orderBy("pre", "kind").rowsBetween(Window.unboundedPreceding, 0)))
    last = F.last("value", True).over(Window.partitionBy(*keys, "open").orderBy("pre", "kind").rowsBetween(Window.unboundedPreceding, 0))
    found = rows.withColumn("found", F.when(F.col("open") > 0, last)).where("kind = 1")
    return found.select(*[F.col(f"kept.{c}").alias(c) if c in others else F.col(c) for c in points.columns], "found")
