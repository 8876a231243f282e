"""Communities: sequential modularity moves for small graphs, parallel ones for large graphs; sizes and labels."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import communities
from .graph import ends_count, projection
from .lineage import cut


def local_moves(pairs: list[tuple[str, str, int]], passes: int = 20) -> dict[str, int]:
    """Greedy modularity: nodes in order of id move to the neighbouring community of largest gain, until none does.

    pairs: undirected edges with weights, in order of first occurrence; that order breaks ties between communities.
    The result is numbered by size, then by smallest member.
    """
    near: dict[str, dict[str, int]] = {}
    for a, b, w in pairs:
        for x, y in ((a, b), (b, a)):
            near.setdefault(x, {})[y] = near.get(x, {}).get(y, 0) + w
    ids = sorted(near)
    strength = {x: sum(near[x].values()) for x in ids}
    double = sum(strength.values())
    of = {x: k for k, x in enumerate(ids)}
    mass = dict(enumerate(strength[x] for x in ids))
    for _ in range(passes):
        moved = False
        for x in ids:
            home, k = of[x], strength[x]
            mass[home] -= k
            pull: dict[int, int] = {}
            for y, w in near[x].items():
                pull[of[y]] = pull.get(of[y], 0) + w
            gain = {c: w - mass[c] * k / double for c, w in pull.items()}
            to, best = home, gain.get(home, -mass[home] * k / double)
            for c, g in gain.items():
                if c != home and g > best + 1e-12:
                    to, best = c, g
            of[x] = to
            mass[to] += k
            moved |= to != home
        if not moved:
            break
    groups: dict[int, list[str]] = {}
    for x in ids:
        groups.setdefault(of[x], []).append(x)
    ordered = sorted(groups.values(), key=lambda g: (-len(g), g[0]))
    return {x: n for n, g in enumerate(ordered) for x in g}


def detect(nodes: DataFrame, edges: DataFrame, passes: int = 20, pairs: DataFrame | None = None) -> DataFrame:
    """(id, community_id) of nodes with edges. The moves are sequential: one task has the whole (core) projection."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        found = local_moves(list(zip(pdf["a"], pdf["b"], pdf["weight"], strict=True)), passes)
        return pd.DataFrame({"id": list(found), "community_id": list(found.values())})

    pairs = (projection(nodes, edges) if pairs is None else pairs).withColumn("place", F.row_number().over(Window.orderBy("first")))
    return pairs.select("a", "b", "weight", "place", F.lit(0).alias("all")).groupBy("all").applyInPandas(run, "id string, community_id long")


#: Edges of a projection that one task moves in sequence; beyond that moves are parallel.
FEW = 200_000


def assign(nodes: DataFrame, edges: DataFrame, few: int = FEW) -> DataFrame:
    """(id, community_id) of nodes with edges, numbered by size, then by smallest member: by detect() where the projection has at
    most `few` edges, by the parallel moves of `communities` where it has more."""
    pairs = cut(projection(nodes, edges))
    if pairs.count() <= few:
        return detect(nodes, edges, pairs=pairs)
    found = communities.detect(pairs)
    size = found.groupBy("community").agg(F.count("*").alias("size"))
    # a number is the place among communities of its size behind all larger ones; sizes differ far less than communities do
    larger = size.groupBy("size").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy(F.desc("size")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    number = size.join(larger.select("size", "before"), "size").select("community", (F.col("before") + F.row_number().over(Window.partitionBy("size").orderBy("community")) - 1).alias("community_id"))
    return found.join(number, "community").select("id", "community_id")


def summarise(assigned: DataFrame, nodes: DataFrame, edges: DataFrame, top: int = 3, label_fn: Callable[[list[str]], str | None] | None = None) -> DataFrame:
    """community_id, label, label_source, size and sorted member_ids, by size.

    The label is the short names of the `top` members of most edge ends. label_fn(member ids) may give another one;
    where it fails or gives nothing the label stays. No network is called here.
    """
    ranked = assigned.join(nodes.select("id", "short_name"), "id").join(ends_count(nodes, edges).select("id", "ends"), "id", "left").withColumn("place", F.row_number().over(Window.partitionBy("community_id").orderBy(F.desc(F.coalesce("ends", F.lit(0))), "id")))
    named = F.transform(F.array_sort(F.collect_list(F.when(F.col("place") <= top, F.struct("place", "short_name")))), lambda x: x["short_name"])
    out = ranked.groupBy("community_id").agg(F.array_join(named, " · ").alias("label"), F.lit("heuristic").alias("label_source"), F.count("*").alias("size"), F.sort_array(F.collect_list("id")).alias("member_ids"))
    if label_fn is None:
        return out

    def safe(ids):
        try:
            return label_fn(list(ids)) or None
        except Exception:
            return None

    own = F.udf(safe, "string")("member_ids")
    return out.withColumn("own", own).select("community_id", F.coalesce("own", "label").alias("label"), F.when(F.col("own").isNotNull(), "given").otherwise("heuristic").alias("label_source"), "size", "member_ids")


def with_communities(nodes: DataFrame, assigned: DataFrame) -> DataFrame:
    return nodes.join(assigned, "id", "left")
