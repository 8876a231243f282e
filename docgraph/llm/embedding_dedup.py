"""Embedding near-dedup: exact balls for dense groups, a forest of random-projection trees with spill for the rest.

Dense groups first. Each vector of a bounded sample (`sample` vectors, those of the smallest hash of vec_id) moves twice to
the mean of its neighbours; places with about TILE / 2 of all vectors within the threshold (4 sample vectors at least) become
centres, until none is left. A vector within the threshold of a centre is in the core of the nearest one. Cores are cut into
RINGS rings by the angle to their centre, and the angles of all their vectors measured; a vector goes to the ball of every
centre that has a ring which reaches to within the threshold's angle of it: whatever it links with is there. So all links of core vectors are found,
however large and dense the group, and each pair is counted in the smaller centre of its cores. A ball of n vectors takes
about n * n / 2 comparisons, as its links are about as many. Vectors with a common direction lie near all centres, but only
the rings that are there count, so a tight core draws what is near it and no more.

The other vectors go through trees. Each tree splits recursively at random directions, at the median of the projections, and
vectors near a split go to both sides. Trees are fitted on the rest of the sample, so deep that a last leaf has about
TILE of all vectors (with 8 sample vectors in each at least); every vector outside the cores is routed by them. Leaves
that still have more than `most` vectors are grown further where they lie: a task fits a tree on a sample of one leaf's
vectors, of about 8 for each new leaf and bounded by `sample` too, and that leaf's vectors are routed on, again until no
leaf is too large. So leaves, and the work for each vector, stay the same however many vectors there are.

All pairs of a leaf or ball are compared by cosine in double precision, so no reported link is below the threshold; one of
many vectors is compared in square tiles. A pair that shares leaves of several trees is counted in the first such leaf only:
vectors carry their leaves of all trees with them. A tile returns counts and a spanning forest, never its pairs. Equal
vectors are one class with a count; the class is compared once.

Recall is below one by design outside the cores; tests hold it against brute force (0.9 is asked for). Vectors that are
null, zero, of another length than the other vector, or hold null or non-finite components link with nothing: n_links 0,
their own component. Rows are told apart by their place in the table, not by vec_id: rows that share a vec_id count as
vectors of their own that are linked if their vectors are. Rows with a null vec_id take part; a group of them alone has a
null component_id. Ties of vec_id have no effect. An empty table gives no rows. Labels and other columns, of whatever
name, are never read.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, kernels

TREES, SAMPLE, SPILL, THRESHOLD = 8, 20_000, 0.06, 0.9
TILE = 1024
RINGS = 8


def _directions(seed: int, dim: int) -> np.ndarray:
    v = np.random.Generator(np.random.PCG64(seed)).standard_normal(dim)
    return v / np.linalg.norm(v)


def centres(x: np.ndarray, least: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Centres of balls that hold `least` rows of x each that no ball before holds; and the rows outside all balls."""
    near = x.astype(np.float32)
    made, count = near.copy(), np.zeros(len(x), np.int64)
    for k in range(0, len(x), 256):
        some = k + np.flatnonzero((near[k : k + 256] @ near.T >= threshold).sum(axis=1) > 1)
        c = near[some]
        for _ in range(2):
            c = (c @ near.T >= threshold).astype(np.float32) @ near
            c /= np.maximum(np.linalg.norm(c, axis=1), 1e-12)[:, None]
        made[some], count[some] = c, (c @ near.T >= threshold).sum(axis=1)
    left, found = np.ones(len(x), bool), []
    for i in np.argsort(-count, kind="stable"):
        if count[i] < least:
            break
        if left[i]:
            own = left & (near @ made[i] >= threshold)
            if own.sum() >= least:
                found.append(made[i])
                left &= ~own
    return np.array(found, np.float64).reshape(len(found), x.shape[1] if x.ndim > 1 else 0), left


def cosines(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return x @ (c / np.linalg.norm(c, axis=1)[:, None]).T


def cores(x: np.ndarray, c: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of x the centre whose core it is in, or -1, and its angle to that centre."""
    if not len(c):
        return np.full(len(x), -1), np.zeros(len(x))
    cos = cosines(x, c)
    nearest = cos.argmax(axis=1)
    most = cos[np.arange(len(x)), nearest]
    return np.where(most >= threshold, nearest, -1), np.arccos(np.clip(most, -1, 1))


def balls(x: np.ndarray, core: np.ndarray, c: np.ndarray, rings: np.ndarray, threshold: float) -> list[np.ndarray]:
    """Of each row of x (and its core) all centres in whose balls it is. rings: (centre, least angle, largest angle) of each
    ring that has vectors."""
    if not len(c):
        return [np.zeros(0, np.int64)] * len(x)
    # the angles of two vectors to a centre differ by no more than the vectors do; rounding is far below a millionth
    angle, reach = np.arccos(np.clip(cosines(x, c), -1, 1)).T, math.acos(max(-1.0, min(1.0, threshold))) + 1e-6
    inside = np.zeros(angle.shape, bool)
    for k, low, high in rings:
        own = angle[int(k)]
        inside[int(k)] |= (own <= high + reach) & (own >= low - reach)
    rows = np.flatnonzero(core >= 0)
    inside[core[rows], rows] = True
    return [np.flatnonzero(r) for r in inside.T]


def grow(x: np.ndarray, leaf: int, spill: float, seed: int) -> list[tuple]:
    """A tree as nested (direction's seed, low, high, left, right) or None for a leaf; rows between low and high go both ways."""

    def node(rows: np.ndarray, at: int, depth: int):
        if len(rows) <= leaf or depth > 40:
            return None
        p = x[rows] @ _directions(at, x.shape[1])
        low, high = np.quantile(p, [0.5 - spill, 0.5 + spill])
        left, right = rows[p <= high], rows[p >= low]
        if len(left) >= len(rows) or len(right) >= len(rows):
            return None
        return at, low, high, node(left, at * 2 + 1, depth + 1), node(right, at * 2 + 2, depth + 1)

    return node(np.arange(len(x)), seed, 0)


def route(tree, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, leaf) of every leaf that each row of x comes to; leaves are numbered as in a heap, by the tree alone."""
    rows, leaves = [], []

    def walk(t, own: np.ndarray, name: int):
        if not len(own):
            return
        if t is None:
            rows.append(own)
            leaves.append(np.full(len(own), name, np.int64))
            return
        p = x[own] @ _directions(t[0], x.shape[1])
        walk(t[3], own[p <= t[2]], name * 2 + 1)
        walk(t[4], own[p >= t[1]], name * 2 + 2)

    walk(tree, np.arange(len(x)), 0)
    return (np.concatenate(rows), np.concatenate(leaves)) if rows else (np.zeros(0, np.int64), np.zeros(0, np.int64))


VECTORS = "rid long, vec_id long, x binary, dim int"


def _vectors(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Unit vectors as bytes, null where a vector links with nothing."""
    col = batch.column(2)
    off, values = col.offsets.to_numpy(), col.values.to_numpy(zero_copy_only=False).astype(np.float64)  # a null component is nan
    size = np.where(col.is_null().to_numpy(zero_copy_only=False), 0, np.diff(off))
    out: list[bytes | None] = [None] * len(size)
    for d in np.unique(size[size > 0]).tolist():
        rows = np.flatnonzero(size == d)
        a = values[off[rows][:, None] + np.arange(d)]
        good = np.isfinite(a).all(axis=1) & a.any(axis=1)
        rows, a = rows[good], a[good]
        a = a / np.abs(a).max(axis=1, initial=0)[:, None]
        a /= np.linalg.norm(a, axis=1)[:, None]
        for r, x in zip(rows.tolist(), a, strict=True):
            out[r] = x.tobytes()
    dim = np.array([len(x) // 8 if x else 0 for x in out], np.int32)
    return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(out, pa.binary()), pa.array(dim)], ["rid", "vec_id", "x", "dim"])


def _matrix(column: pa.Array, rows: np.ndarray | None = None) -> np.ndarray:
    return np.array([np.frombuffer(column[int(i)].as_buffer(), np.float64) for i in (range(len(column)) if rows is None else rows)])


def _nested(row: np.ndarray, tree: np.ndarray, leaf: np.ndarray, n: int, trees: int) -> pa.Array:
    """array<array<long>>: the leaves of each of n rows by tree."""
    order = np.lexsort((tree, row))
    ends = np.concatenate([[0], np.cumsum(np.bincount(row * trees + tree, minlength=n * trees))]).astype(np.int32)
    return pa.ListArray.from_arrays(np.arange(0, n * trees + 1, trees, dtype=np.int32), pa.ListArray.from_arrays(ends, pa.array(leaf[order])))


class Tile:
    """Two blocks of the vectors of a leaf of one tree or of a ball (tree -1), or one block with itself, in one task."""

    def __init__(self, tree: int, leaf: int, rows: list[tuple], threshold: float):
        self.tree, self.leaf, self.threshold = tree, leaf, threshold
        self.ids, self.copies, self.side, self.core = (np.array([r[i] for r in rows], np.int64) for i in range(4))
        self.x = np.array([np.frombuffer(r[4], np.float64) for r in rows])
        if tree >= 0:
            width = max(len(v) for r in rows for v in r[5])
            self.leaves = np.array([[v + [-1] * (width - len(v)) for v in r[5]] for r in rows], np.int64)  # rows x trees x leaves
        self.links = np.zeros(len(rows), np.int64)
        self.root = np.arange(len(rows))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def compare(self, same: bool) -> None:
        a = np.flatnonzero(self.side == 0)
        b = a if same else np.flatnonzero(self.side == 1)
        for i in range(0, len(a), TILE):
            for j in range(i if same else 0, len(b), TILE):
                p, q = a[i : i + TILE], b[j : j + TILE]
                link = self.x[p] @ self.x[q].T >= self.threshold
                if same and i == j:
                    link = np.triu(link, 1)
                u, v = np.nonzero(link)
                if len(u):
                    self.take(p[u], q[v])

    def compare_ball(self, same: bool) -> None:
        inside = self.core == self.leaf
        a, b = np.flatnonzero(self.side == 0), np.flatnonzero(self.side == 1)
        core, shell = a[inside[a]], a[~inside[a]]
        for p, q, half in [(core, core, True), (core, shell, False)] if same else [(core, b, False), (shell, b[inside[b]], False)]:
            for i in range(0, len(p), TILE):
                for j in range(i if half else 0, len(q), TILE):
                    self.take_block(p[i : i + TILE], q[j : j + TILE], half and i == j)

    def take_block(self, p: np.ndarray, q: np.ndarray, half: bool) -> None:
        link = self.x[p] @ self.x[q].T >= self.threshold
        if half:
            link = np.triu(link, 1)
        # a pair with two cores meets in both balls: it counts in the smaller one
        own = np.where(self.core < 0, np.iinfo(np.int64).max, self.core)
        link &= (own[p] >= self.leaf)[:, None] & (own[q] >= self.leaf)[None, :]
        some = link.astype(np.float64)
        self.links[p] += (some @ self.copies[q]).astype(np.int64)
        self.links[q] += (self.copies[p] @ some).astype(np.int64)
        while True:
            link &= self.root[p][:, None] != self.root[q][None, :]
            rows = np.flatnonzero(link.any(axis=1))
            if not len(rows):
                return
            self.unite(p[rows], q[link[rows].argmax(axis=1)])

    def unite(self, u: np.ndarray, v: np.ndarray) -> None:
        """Joins the groups of u[i] and v[i]: of the roots that meet, each larger one hooks onto a smaller one at a time."""
        while True:
            a, b = self.root[u], self.root[v]
            apart = a != b
            if not apart.any():
                return
            u, v, high, low = u[apart], v[apart], np.maximum(a, b)[apart], np.minimum(a, b)[apart]
            high, first = np.unique(high, return_index=True)
            to = np.arange(len(self.root))
            to[high] = low[first]
            self.edges.append((u[first], v[first]))
            while (to[to] != to).any():
                to = to[to]
            self.root = to[self.root]

    def take(self, u: np.ndarray, v: np.ndarray) -> None:
        keep = np.ones(len(u), bool)
        for t in range(self.tree + 1):  # those that met in an earlier tree, or in an earlier leaf of this one
            a, b = self.leaves[u, t], self.leaves[v, t]
            for i in range(a.shape[1]):
                for j in range(b.shape[1]):
                    met = (a[:, i] == b[:, j]) & (a[:, i] >= 0)
                    keep &= ~(met & (a[:, i] < self.leaf)) if t == self.tree else ~met
        u, v = u[keep], v[keep]
        np.add.at(self.links, u, self.copies[v])
        np.add.at(self.links, v, self.copies[u])
        self.unite(u, v)


LEAF = ["dim", "tree", "leaf"]


def _child(leaf: np.ndarray | int, below: np.ndarray) -> np.ndarray:
    """The name of a leaf below a leaf: not negative."""
    u = np.uint64
    return (kernels.mix(np.asarray(leaf).astype(u) * u(0x9E3779B97F4A7C15) + below.astype(u) + u(1)) >> u(1)).astype(np.int64)


def deepened(at: DataFrame, x: DataFrame, most: int, sample: int, spill: float) -> DataFrame:
    """at (cid, dim, tree, leaf) with every leaf of more than `most` vectors grown further; x: (cid, x).

    Nothing of a leaf is ever in one place but the tree that is fitted on its sample. A leaf that does not split (its vectors
    are alike) stays as it is: it is compared in tiles.
    """
    each = 8 / max(8, most // 2)  # of the vectors of a leaf, those in its sample: 8 for each new leaf
    done = None

    def fitted(batches):
        key, own = None, []

        def made():
            tree = grow(np.array([np.frombuffer(v, np.float64) for v in own]), 8, spill, int(_child(key[2], np.array([key[1] + 7]))[0]) >> 2)
            return pa.RecordBatch.from_pylist([dict(zip(LEAF, key, strict=True), subtree=pickle.dumps(tree))], schema)

        schema = pa.schema([("dim", pa.int32()), ("tree", pa.int32()), ("leaf", pa.int64()), ("subtree", pa.binary())])
        for batch in batches:
            for *k, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if key:
                        yield made()
                    key, own = k, []
                own.append(v)
        if key:
            yield made()

    def routed(batches):
        key, tree = None, None
        for batch in batches:  # of a leaf and part, the tree comes first
            place = [*zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True)]
            k = 0
            while k < len(place):
                j = next((j for j in range(k + 1, len(place)) if place[j] != place[k] or place[j - 1] != place[k]), len(place))
                own = batch.slice(k, j - k)
                if place[k] != key:
                    key, tree = place[k], pickle.loads(own.column(6)[0].as_py())
                    own = own.slice(1)
                if own.num_rows:
                    row, below = route(tree, _matrix(own.column(6)))
                    yield pa.RecordBatch.from_arrays([own.column(5).take(row), own.column(0).take(row), own.column(1).take(row), pa.array(_child(key[2], below)), pa.array(np.full(len(row), tree is None))], ["cid", *LEAF, "stuck"])
                k = j

    while True:
        size = at.groupBy(*LEAF).agg(F.count("*").alias("n"))
        big = common.cut(size.where((F.col("tree") >= 0) & (F.col("n") > most)), "rp-big")
        if big.isEmpty():
            return at if done is None else at.union(done)
        large = common.join_hot(at, big, LEAF, "cid", "left")
        fine = large.where("n is null").select("cid", *LEAF)
        rows = common.cut(large.where("n is not null").join(x, "cid"), "rp-large")
        bound = F.least(F.lit(each), sample / F.col("n")) * (1 << 30)
        picked = rows.where(F.pmod(F.xxhash64("cid", "tree"), F.lit(1 << 30)) < bound).select(*LEAF, "x")
        trees = picked.repartition(*LEAF).sortWithinPartitions(*LEAF).mapInArrow(fitted, "dim int, tree int, leaf long, subtree binary")
        parts = big.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor(F.col("n") / (1 << 16)).cast("int"))))
        none = F.lit(pickle.dumps(None))  # where a sample came out empty; the leaf then stays as it is
        trees = parts.join(trees, LEAF, "left").select(*LEAF, "part", F.lit(0).alias("row"), F.lit(0).cast("long").alias("cid"), F.coalesce("subtree", none).alias("x"))
        rows = rows.select(*LEAF, F.pmod(F.xxhash64("cid"), F.floor(F.col("n") / (1 << 16)) + 1).cast("int").alias("part"), F.lit(1).alias("row"), "cid", "x")
        down = trees.union(rows).repartition(*LEAF, "part").sortWithinPartitions(*LEAF, "part", "row").mapInArrow(routed, "cid long, dim int, tree int, leaf long, stuck boolean")
        down = common.cut(down, "rp-deeper")
        fine = fine.union(down.where("stuck").drop("stuck"))
        done = common.cut(fine if done is None else done.union(fine), "rp-done")
        at = down.where("not stuck").drop("stuck")


def link(vectors: DataFrame, threshold: float = THRESHOLD, trees: int = TREES, sample: int = SAMPLE, spill: float = SPILL, part: int = 2 * TILE, most: int = 4 * TILE) -> DataFrame:
    """rid, vec_id, n_links, component_id of every row of vectors (vec_id, embedding).

    part: a leaf of more vectors is dealt to tasks as pairs of parts of about this size, a ball as pairs of 8 times it.
    """
    vectors = vectors.select(F.monotonically_increasing_id().alias("rid"), F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>"))
    made = common.cut(common.arrow_map(vectors, _vectors, VECTORS), "rp-vectors")
    good = made.where("x is not null")
    classes = good.groupBy("x", "dim").agg(F.min(F.struct(F.col("vec_id").isNull().alias("none"), "vec_id", "rid")).alias("least"), F.count("*").alias("copies"))
    classes = common.cut(classes.select(F.monotonically_increasing_id().alias("cid"), "least", "copies", "x", "dim"), "rp-classes")
    forests = {}
    for d, n in sorted((r.dim, r["count"]) for r in classes.groupBy("dim").count().collect()):
        rows = classes.where(F.col("dim") == d).select("x", F.xxhash64("x").alias("h")).orderBy("h", "x").limit(sample).collect()
        x = np.array([np.frombuffer(r.x, np.float64) for r in rows])
        leaf = max(8, len(x) * TILE // n)
        middle, left = centres(x, leaf // 2, threshold)
        forests[d] = middle, [grow(x[left], leaf, spill, 7919 * (t + 1)) for t in range(trees)]
    shipped = vectors.sparkSession.sparkContext.broadcast(forests)  # bounded by sample / 4 centres and trees x sample / 8 nodes

    def routed(batch: pa.RecordBatch) -> pa.RecordBatch:
        dim = batch.column(3).to_numpy()
        core, angle, places = np.full(len(dim), -1), np.zeros(len(dim)), [[np.zeros(0, np.int64)] * 3]
        for d in np.unique(dim):
            own = np.flatnonzero(dim == d)
            x = _matrix(batch.column(2), own)
            middle, forest = shipped.value[int(d)]
            core[own], angle[own] = cores(x, middle, threshold)
            out = np.flatnonzero(core[own] < 0)
            for t, tree in enumerate(forest):
                row, leaf = route(tree, x[out])
                places.append([own[out[row]], np.full(len(row), t), leaf])
        row, tree, leaf = (np.concatenate(c) for c in zip(*places, strict=True))
        return pa.RecordBatch.from_arrays([*batch.columns[:4], _nested(row, tree, leaf, len(dim), trees), pa.array(core, pa.int64()), pa.array(angle)], ["cid", "copies", "x", "dim", "leaves", "core", "angle"])

    dealt = common.cut(common.arrow_map(classes.select("cid", "copies", "x", "dim"), routed, "cid long, copies long, x binary, dim int, leaves array<array<bigint>>, core long, angle double"), "rp-routed")
    turn = math.acos(max(-1.0, min(1.0, threshold)))
    # at most RINGS + 1 rows for each centre
    ring = F.floor(F.col("angle") * (RINGS / (turn or 1e-9)))
    measured = dealt.where("core >= 0").groupBy("dim", "core", ring.alias("ring")).agg(F.min("angle").alias("low"), F.max("angle").alias("high")).orderBy("dim", "core", "ring").collect()
    rings = {d: np.array([(r.core, r.low, r.high) for r in measured if r.dim == d]).reshape(-1, 3) for d in forests}

    def placed(batch: pa.RecordBatch) -> pa.RecordBatch:
        dim, core, near = batch.column(1).to_numpy(), batch.column(2).to_numpy(), [[] for _ in range(batch.num_rows)]
        for d in np.unique(dim):
            own = np.flatnonzero(dim == d)
            for r, k in zip(own, balls(_matrix(batch.column(3), own), core[own], shipped.value[int(d)][0], rings[int(d)], threshold), strict=True):
                near[r] = k.tolist()
        return pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(near, pa.list_(pa.int64()))], ["cid", "dim", "near"])

    near = common.arrow_map(dealt.select("cid", "dim", "core", "x"), placed, "cid long, dim int, near array<bigint>")
    near = common.cut(near.select("cid", "dim", F.lit(-1).alias("tree"), F.explode("near").alias("leaf")), "rp-near") if measured else None
    at = dealt.select("cid", "dim", F.posexplode("leaves").alias("tree", "own")).select("cid", "dim", "tree", F.explode("own").alias("leaf"))
    deeper = deepened(at, classes.select("cid", "x"), most, sample, spill)
    if deeper is not at:
        own = deeper.groupBy("cid").agg(F.collect_list(F.struct("tree", "leaf")).alias("all"))  # trees times a few
        by_tree = F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.transform(F.filter("all", lambda p: p["tree"] == t), lambda p: p["leaf"]))
        none = F.array_repeat(F.array().cast("array<bigint>"), trees)
        dealt = common.cut(dealt.drop("leaves").join(own, "cid", "left").withColumn("leaves", F.coalesce(by_tree, none)).drop("all"), "rp-leaves")
    at = deeper.select("cid", *LEAF)
    at = at if near is None else at.union(near.select("cid", *LEAF))
    size = at.groupBy(*LEAF).agg(F.ceil(F.count("*") / F.when(F.col("tree") < 0, 8 * part).otherwise(part)).cast("int").alias("parts"))
    at = common.join_hot(at, size, LEAF, "cid").withColumn("mine", F.pmod(F.xxhash64("cid"), F.col("parts")).cast("int"))
    at = at.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "cid", "tree", "leaf", F.concat_ws(":", *LEAF, F.least("mine", "other"), F.greatest("mine", "other")).alias("key"), (F.col("mine") > F.col("other")).cast("int").alias("side")
    )
    rows = at.join(dealt.select("cid", "copies", "x", "leaves", "core"), "cid").select("key", "tree", "leaf", "cid", "copies", "side", "core", "x", F.when(F.col("tree") >= 0, F.col("leaves")).alias("leaves"))

    def compare(batches):
        key, own = None, []

        def done():
            b = Tile(*own[0][:2], [r[2:] for r in own], threshold)
            i, j = key.split(":")[3:]
            (b.compare_ball if b.tree < 0 else b.compare)(i == j)
            linked = np.flatnonzero(b.links)
            u, v = (np.concatenate([np.zeros(0, np.int64), *(e[k] for e in b.edges)]) for k in (0, 1))
            second = pa.chunked_array([pa.array(b.ids[v]), pa.nulls(len(linked), pa.int64())]).combine_chunks()
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate([b.ids[u], b.ids[linked]])), second, pa.array(np.concatenate([np.zeros(len(u), np.int64), b.links[linked]]))], ["a", "b", "links"])

        for batch in batches:
            for k, *r in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if k != key:
                    if own:
                        yield done()
                    key, own = k, []
                own.append(r)
        if own:
            yield done()

    found = common.cut(rows.repartition("key").sortWithinPartitions("key").mapInArrow(compare, "a long, b long, links long"), "rp-links")
    links = found.where("b is null").groupBy(F.col("a").alias("cid")).agg(F.sum("links").alias("links"))
    group = common.components(found.where("b is not null").select("a", "b"), what="rp-cc")
    known = common.named(classes.join(links, "cid", "left"), group, "cid", "least").select("x", "dim", "copies", "links", "_least")
    known = common.join_hot(good, known, ["x", "dim"], "rid").select("rid", "vec_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("_least.vec_id").alias("component_id"))
    return known.union(made.where("x is null").select("rid", "vec_id", F.lit(0).cast("long"), "vec_id"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = link(common.table(spark, sf_dir, "embeddings")).drop("rid")
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
