"""Communities at any size: modularity moves in parallel by turns, and contraction into levels; all of it joins.

Nodes are numbered by the place of their id among all ids, edges by the numbers of their ends. Each level stores its edges once, from both ends, in
buckets by the end whose label they ask for (`hold`): labels come to the edges, and what they pull goes once to the node that
may move. Nodes are dealt to turns by hash. In a sweep each turn looks at the communities of its neighbours and moves to the one of
largest gain in modularity, the smallest of equals, if it gains more than where it is. All nodes of a turn see the same
state, so the result does not depend on partitioning. Neighbours of one turn may move at once, and masses of communities change under nodes that
move together; so of two lone nodes only one may join the other, and a sweep counts only if modularity grew, else the state before it is kept and
the level ends. It also ends when a sweep gains little. Then each community becomes one node, edges between two become one, and the next level
goes on, until no node moves or until few edges are left: these one task moves in sequence, level by level. At last single nodes
have one more sweep among the communities so found, which counts if modularity grows.

Sums of each step are combined, and each step is cut to the shared folder. Nothing is collected but a few of these sums. Weights are whole
numbers; so is all that gains are made of. Nodes of very many edges are dealt to parts where they are asked for; where they move
themselves, their pulls meet in one task that holds a sum for each community around them. `detect` of `community` is the
sequential form of this, for graphs that one task holds. `colours` gives turns in which no neighbours are, at the price of some joins of all edges.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .lineage import cut, scratch


def both_ways(pairs: DataFrame) -> DataFrame:
    """id, near, weight: each edge (a, b, weight) from both of its ends, loops left out, parallel edges as one."""
    e = pairs.where("a <> b").select("a", "b", "weight")
    return e.union(e.select("b", "a", "weight")).toDF("id", "near", "weight").groupBy("id", "near").agg(F.sum("weight").alias("weight"))


#: Rounds of exact colouring, and classes for the nodes that these leave.
ROUNDS, SPREAD = 4, 4


def colours(both: DataFrame, rounds: int | None = ROUNDS, spread: int = SPREAD) -> DataFrame:
    """id and colour of the nodes of both (id, near, weight). No two neighbours have one colour, but for the last `spread` colours
    of those nodes that as many rounds leave; rounds=None goes on until there are none.

    Each round is a join with the colours so far. A round colours the first node of every component at least.
    """
    first = both.groupBy("id").agg(F.struct(F.count("*").alias("degree"), F.xxhash64("id").alias("h"), F.col("id").alias("own")).alias("rank"))
    left = cut(both.select("id", "near").join(first, "id").join(first.select(F.col("id").alias("near"), F.col("rank").alias("other")), "near").select("id", "near", (F.col("rank") > F.col("other")).alias("before")))
    # nodes wait for those neighbours that come before them
    done = cut(left.groupBy("id").agg(F.every("before").alias("now")).where("now").select("id", F.lit(0).alias("colour")))
    waits = cut(left.where("not before").select("id", "near"))
    k = 1
    while True:
        open_ = waits.join(done.select("id"), "id", "left_anti")
        if rounds is not None and k >= rounds:
            left = open_.select("id").distinct()
            return done.union(left.select("id", (F.pmod(F.xxhash64("id"), F.lit(spread)) + rounds).cast("int").alias("colour")))
        seen = open_.join(done.select(F.col("id").alias("near"), "colour"), "near", "left")
        ready = seen.groupBy("id").agg(F.every(F.col("colour").isNotNull()).alias("now"), F.array_sort(F.collect_set("colour")).alias("taken")).where("now")
        # the smallest number that is not taken: where the sorted ones leave the count 0, 1, 2 ...
        free = F.coalesce(F.filter(F.sequence(F.lit(0), F.size("taken")), lambda k: ~F.array_contains("taken", k))[0], F.lit(0))
        new = cut(ready.select("id", free.alias("colour")))
        if new.isEmpty():
            return done
        done, k = cut(done.union(new)), k + 1


def double_modularity(both: DataFrame, state: DataFrame) -> tuple[int, int]:
    """(q, double): modularity is q / double**2, where double is twice the weight of all edges; state: id, label, k, inner.

    inner is the weight, counted from both ends, that a node of a higher level has within itself.
    """
    of = state.select("id", "label")
    return _double(both.join(of, "id").join(of.toDF("near", "other"), "near").agg(F.coalesce(F.sum(F.when(F.col("label") == F.col("other"), F.col("weight"))), F.lit(0)).alias("w")), state)


def _double(inside: DataFrame, state: DataFrame) -> tuple[int, int]:
    """double_modularity, where the weight between nodes of one label is known: one row, w."""
    wide = lambda c: F.sum(c.cast("decimal(38,0)"))
    masses = state.groupBy("label").agg(F.sum("k").alias("mass")).agg(wide(F.col("mass").cast("decimal(19,0)") * F.col("mass").cast("decimal(19,0)")).alias("squares"), F.sum("mass").alias("double"))
    r = inside.crossJoin(masses).crossJoin(state.agg(F.sum("inner").alias("inner"))).first()  # one row each
    double = int(r["double"] or 0)
    return (int(r["w"]) + int(r["inner"] or 0)) * double - int(r["squares"] or 0), double


@dataclass
class Held:
    """rows: id, near, weight, turn and part, in buckets by near and part; hubs: (hub, parts) of the nodes that are dealt to parts."""

    rows: DataFrame
    hubs: DataFrame
    table: str

    def told(self, nodes: DataFrame, turn: int | None = None) -> DataFrame:
        """The rows (of a turn) with the columns of nodes (near and others): these come to the buckets, no edge is exchanged."""
        rows = self.rows if turn is None else self.rows.where(F.col("turn") == turn)
        dealt = nodes.join(F.broadcast(self.hubs), F.col("near") == F.col("hub"), "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1))).drop("hub", "parts")
        return rows.join(dealt.hint("shuffle_hash"), ["near", "part"]).drop("part", "turn")

    def drop(self) -> None:
        self.rows.sparkSession.sql(f"DROP TABLE IF EXISTS {self.table}")


#: Turns of a sweep; edges of a bucket.
TURNS, BUCKET = 4, 1_000_000


def hold(half: DataFrame, turns: int = TURNS, bucket: int = BUCKET) -> tuple[Held, DataFrame]:
    """Edges (id < near, weight) from both ends, stored by the end whose label they ask for; and id and k, the weight around each node.

    Nodes with more than `bucket` edges are dealt to parts, so that no bucket has all of them.
    """
    spark = half.sparkSession
    both = half.select("id", "near", "weight").union(half.select("near", "id", "weight"))
    degrees = cut(both.groupBy("id").agg(F.count("*").alias("degree"), F.sum("weight").alias("k")))
    hubs = cut(degrees.where(F.col("degree") > bucket).select(F.col("id").alias("hub"), F.ceil(F.col("degree") / bucket).cast("int").alias("parts")))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-2 * half.count() // bucket))
    dealt = both.join(F.broadcast(hubs), F.col("near") == F.col("hub"), "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("id"), "parts").cast("int"), F.lit(0))).drop("hub", "parts")
    table = f"edges_{uuid.uuid4().hex}"
    rows = dealt.withColumn("turn", F.pmod(F.xxhash64("id"), F.lit(turns)).cast("int")).repartition(n, "near", "part")
    rows.write.partitionBy("turn").bucketBy(n, "near", "part").option("path", scratch(spark, table)).saveAsTable(table)
    return Held(spark.table(table), hubs, table), degrees.select("id", "k")


def sweep(held: Held, state: DataFrame, turns: int, double: int) -> DataFrame:
    """state after the nodes of each turn have moved."""
    for c in range(turns):
        masses = state.groupBy("label").agg(F.sum("k").alias("mass"), (F.count("*") == 1).alias("lone"))
        now = state.join(masses, "label")  # no hint: where communities are few and large, masses are broadcast
        around = held.told(now.select(F.col("id").alias("near"), "label", "mass", "lone"), c)
        own = now.where(F.pmod(F.xxhash64("id"), F.lit(turns)) == c).select("id", F.col("label").alias("home"), "k", F.col("mass").alias("at_home"), F.col("lone").alias("alone"))
        # pulls go to their node once, and are summed there
        choice = around.join(own.hint("shuffle_hash"), "id").groupBy("id", "label").agg(F.sum("weight").alias("pull"), *(F.max(x).alias(x) for x in ("mass", "lone", "home", "k", "at_home", "alone")))
        gain = F.col("pull").cast("double") * double - F.col("k").cast("double") * (F.col("mass") - F.when(F.col("label") == F.col("home"), F.col("k")).otherwise(0))
        stay = -F.col("k").cast("double") * (F.col("at_home") - F.col("k"))  # where no neighbour is at home
        # of two lone nodes one joins the other, else they might change places
        swap = F.col("alone") & F.col("lone") & (F.col("label") > F.col("home"))
        rated = choice.where(~swap).select("id", "label", "home", gain.alias("gain"), stay.alias("stay")).where("gain > stay")
        best = rated.groupBy("id").agg(F.min(F.struct((-F.col("gain")).alias("g"), (F.col("label") != F.col("home")).alias("away"), "label")).alias("b")).select("id", F.col("b.label").alias("to"))
        state = cut(state.join(best, "id", "left").select("id", F.coalesce("to", "label").alias("label"), "k", "inner"))
    return state


#: Gain in modularity below which another sweep is not worth its joins; and the part of a level's best sweep below which moves go on at
#: the next level, where they are cheaper.
LEAST, SLOW = 1e-3, 4


def inside(held: Held, state: DataFrame) -> DataFrame:
    """Edges once, with the labels of both ends: label, other, weight."""
    of = state.select("id", "label")
    return held.told(of.toDF("near", "other")).where("id < near").select("id", "other", "weight").join(of.hint("shuffle_hash"), "id").select("label", "other", "weight")


def _measure(edges: DataFrame, state: DataFrame) -> tuple[int, int]:
    """double_modularity from the edges of inside()."""
    return _double(edges.agg(F.coalesce(F.sum(F.when(F.col("label") == F.col("other"), 2 * F.col("weight"))), F.lit(0)).alias("w")), state)


def level(held: Held, state: DataFrame, least: float = LEAST, turns: int = TURNS) -> tuple[DataFrame, bool, int, int]:
    """(state, whether any node moved, q, double) after sweeps until modularity, which is q / double**2, grows by less than `least`."""
    q, double = _measure(inside(held, state), state)
    moved, most = False, 0
    while double:
        new = sweep(held, state, turns, double)
        now, _ = _measure(inside(held, new), new)
        if now <= q:
            break
        most = max(most, now - q)
        small = (now - q) / double**2 < least or (now - q) * SLOW < most
        state, q, moved = new, now, True
        if small:
            break
    return state, moved, q, double


#: Edges of a graph that one task moves in sequence.
FEW = 200_000


def _in_sequence(rows: pd.DataFrame) -> pd.DataFrame:
    """id and label after sequential moves and contractions, until no node moves. rows: edges (id < near, weight), and nodes with near null, their k
    as the weight and inner."""
    nodes, edges = rows[rows["near"] < 0].sort_values("id"), rows[rows["near"] >= 0].sort_values(["id", "near"])
    of = {x: x for x in nodes["id"].tolist()}
    k = dict(zip(nodes["id"].tolist(), nodes["weight"].tolist(), strict=True))
    double = sum(k.values())
    near: dict[int, dict[int, int]] = {x: {} for x in k}
    for a, b, w in zip(edges["id"].tolist(), edges["near"].tolist(), edges["weight"].tolist(), strict=True):
        near[a][b] = near[b][a] = w
    while True:
        at, mass, any_moved = {x: x for x in k}, dict(k), False
        moved = True
        while moved:
            moved = False
            for x in k:
                home, own = at[x], k[x]
                mass[home] -= own
                pull: dict[int, int] = {home: 0}
                for y, w in near[x].items():
                    pull[at[y]] = pull.get(at[y], 0) + w
                # whole numbers, so each move raises modularity and the loop ends
                to = max(pull, key=lambda c: (pull[c] * double - mass[c] * own, c == home, -c))
                at[x] = to
                mass[to] += own
                moved |= to != home
            any_moved |= moved
        if not any_moved:
            return pd.DataFrame({"id": list(of), "label": list(of.values())}, dtype="int64")
        of = {x: at[c] for x, c in of.items()}
        joined: dict[int, dict[int, int]] = {}
        for x in k:
            mine = joined.setdefault(at[x], {})
            for y, w in near[x].items():
                if at[y] != at[x]:
                    mine[at[y]] = mine.get(at[y], 0) + w
        k = {c: mass[c] for c in joined}
        near = joined


def in_sequence(half: DataFrame, state: DataFrame) -> DataFrame:
    """id and label after sequential moves in one task; for graphs of at most FEW edges."""
    rows = half.select("id", "near", "weight").union(state.select("id", F.lit(-1).cast("long"), "k"))
    return rows.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(lambda rows: _in_sequence(rows), "id long, label long")


def numbered(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(names, half): id and number of the nodes, which is the place of the id among all of them; edges (id < near, weight) by number, loops left
    out, parallel edges as one."""
    e = pairs.where("a <> b").select("a", "b", "weight")
    ids = cut(e.select(F.explode(F.array("a", "b")).alias("id")).distinct())
    # places within sorted parts, and the sizes of the parts before
    placed = cut(ids.orderBy("id").select("id", F.monotonically_increasing_id().alias("m")).withColumn("piece", F.shiftright("m", 33)).withColumn("m", F.col("m").bitwiseAND((1 << 33) - 1)))
    before = placed.groupBy("piece").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))  # a row for each part
    names = cut(placed.join(F.broadcast(before.select("piece", "before")), "piece").select("id", (F.col("before") + F.col("m")).alias("number")))
    of = lambda c, n: names.select(F.col("id").alias(c), F.col("number").alias(n)).hint("shuffle_hash")
    half = e.join(of("a", "x"), "a").select("b", "x", "weight").join(of("b", "y"), "b")
    return names, cut(half.groupBy(F.least("x", "y").alias("id"), F.greatest("x", "y").alias("near")).agg(F.sum("weight").alias("weight")))


def detect(pairs: DataFrame, least: float = LEAST, few: int = FEW, turns: int = TURNS) -> DataFrame:
    """id and community, the smallest id in it, of all nodes of undirected edges (a, b, weight). Nodes without edges have none."""
    names, half = numbered(pairs)
    first = state = None
    members = names.select("number", F.col("number").alias("node"))
    while half.count() > few:
        held, around = hold(half, turns)
        if state is None:
            state = cut(around.select("id", F.col("id").alias("label"), "k", F.lit(0).cast("long").alias("inner")))
            first = held, state
        state, moved, q, double = level(held, state, least, turns)
        if moved:
            members = cut(members.join(state.select(F.col("id").alias("node"), "label"), "node").select("number", F.col("label").alias("node")))
            joined = cut(inside(held, state).groupBy(F.least("label", "other").alias("id"), F.greatest("label", "other").alias("near")).agg(F.sum("weight").alias("weight")))
            within = joined.where("id = near").select(F.col("id").alias("label"), (2 * F.col("weight")).alias("w"))
            state = state.groupBy("label").agg(F.sum("k").alias("k"), F.sum("inner").alias("inner")).join(within, "label", "left")
            state = cut(state.select(F.col("label").alias("id"), "label", "k", (F.col("inner") + F.coalesce("w", F.lit(0))).alias("inner")))
            half = joined.where("id <> near")
        if held is not first[0]:
            held.drop()
        if not moved:
            break
    else:
        if state is None:
            around = half.select("id", "weight").union(half.select("near", "weight")).groupBy("id").agg(F.sum("weight").alias("k"))
            state = cut(around.select("id", "k", F.lit(0).cast("long").alias("inner")))
        of = cut(in_sequence(half, state))
        members = cut(members.join(of.withColumnRenamed("id", "node"), "node").select("number", F.col("label").alias("node")))
        if first:
            edges = half.join(of, "id").join(of.toDF("near", "other"), "near")
            q, double = _measure(edges, state.select("id", "k", "inner").join(of, "id"))
    if first:
        # single nodes once more, among the communities that all levels made
        held, alone = first
        state = cut(alone.select("id", "k", "inner").join(members.toDF("id", "label"), "id").select("id", "label", "k", "inner"))
        new = sweep(held, state, turns, double)
        if _measure(inside(held, new), new)[0] > q:
            members = new.select(F.col("id").alias("number"), F.col("label").alias("node"))
        held.drop()
    least_of = members.groupBy("node").agg(F.min("number").alias("least"))
    found = members.join(least_of, "node").join(names, "number").select("id", "least")
    return found.join(names.select(F.col("number").alias("least"), F.col("id").alias("community")), "least").select("id", "community")


def modularity(pairs: DataFrame, assigned: DataFrame) -> float:
    """Of the partition (id, community) of undirected edges (a, b, weight)."""
    both = both_ways(pairs)
    k = both.groupBy("id").agg(F.sum("weight").alias("k"))
    q, double = double_modularity(both, assigned.join(k, "id").select("id", F.col("community").alias("label"), "k", F.lit(0).cast("long").alias("inner")))
    return q / double**2 if double else 0.0
