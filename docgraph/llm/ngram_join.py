"""N-gram Jaccard join: T-occurrence search over sets of five-word shingles, by DivideSkip.

A set links to another when 100 * intersection >= 80 * union. With n and m elements the intersection is then at
least T = ceil(4 (n + m) / 9), and at least ceil(0.8 n), so of any n - ceil(0.8 n) + 1 elements of a set (its prefix,
the rarest ones) one is in the prefix of the other. Elements that one document alone has (most of them) can't be shared:
a document with a whole prefix of its own has no link and leaves. The steps, none of which emits pairs:

1. One pass over the texts makes the sets. Shingle hashes go out in byte blocks by hash range, 8 bytes each. A hash
   that several documents of a block have goes out once, with their number: a very common one costs a range an entry
   for each block, not for each document.
2. Every range finds the hashes of two documents or more and returns them, with how frequent they are, to the
   block of documents they came from. Only these shared hashes travel on.
3. A document keeps its shared hashes if it can link at all. Equal sets become one class with a representative.
4. The inverted lists are cut into tiles. A representative belongs to the list of the most frequent element of its
   prefix, there to its class of size, and to one of as many tiles as these have times `tile` members.
5. Prefix elements that stand in several tiles route a set to the other tiles that have it and a size that fits; of
   two tiles one is sent to the other. A set comes to a tile once, however many elements they share. Many sets that
   are sent to one tile are dealt to several tasks, each with the tile.
6. A tile is an index of inverted lists. Each set of it, and each one sent to it, runs the T-occurrence search: the
   short lists are merged by a heap and counted, the long ones binary-probed for what is left (DivideSkip). A tile
   returns link counts and a spanning forest.
7. Components of the forest name the groups.

Elements are hashes of 64 bits. Rows are told apart by their place in the table, not by doc_id: repeated rows, and texts
that share a doc_id, stand for themselves, each is returned and counts as a link of the others. Rows with a null doc_id take
part; a group of them alone has a null component_id. Texts that are null or without words have an empty set and link
with nothing. A very long text is one set of many elements, a tile holds about SIZE bytes of sets. Ties: equal doc_ids
count in the order of rows. An empty table gives no rows. Other columns, of whatever name, are never read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, kernels

#: Sets of a tile, their bytes, and sets that come to it in one task; bytes of text of one block of documents.
TILE, SIZE, SENT, BLOCK = 128, 4 << 20, 128, 6 << 20
U64 = np.uint64
ROW = np.dtype([("rid", "<i8"), ("doc", "<i8"), ("null", "?"), ("n", "<i8")])


def least_overlap(n: int, m: int) -> int:
    return -(-4 * (n + m) // 9)


def prefix(n: np.ndarray) -> np.ndarray:
    """How many elements of a set of n are enough to meet each set that it links with."""
    return n - -(-4 * n // 5) + 1


def _binary(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([x.tobytes() for x in arrays], pa.binary())


def _spread(docs: DataFrame, ranges: int) -> DataFrame:
    """(range, block, kind, a, b): kind 0 has shingle hashes and their documents' places, kind 1 rows and set sizes,
    kind 2 hashes of several documents of the block and how many, kind 3 (for the block itself) these with all places."""

    def run(batches):
        block = (TaskContext.get().partitionId() << 32) - 1
        for batch in batches:
            for part in common.by_bytes(batch, "text", BLOCK):
                for k in range(0, part.num_rows, 65536):
                    some = part.slice(k, 65536)
                    block += 1
                    each = kernels.sets(some.column(2))
                    size = np.array([len(x) for x in each], np.int64)
                    h = np.concatenate(each) if each else np.zeros(0, U64)
                    place = np.repeat(np.arange(len(each), dtype=np.uint16), size)
                    # in order of the hashes, and so of the ranges
                    order = np.argsort(h, kind="stable")
                    h, place = h[order], place[order]
                    new = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
                    count = np.diff(np.append(new, len(h)))
                    several = np.repeat(count > 1, count)
                    ids = np.empty(some.num_rows, ROW)
                    ids["rid"], ids["doc"], ids["null"], ids["n"] = some.column(0).to_numpy(), some.column(1).fill_null(0).to_numpy(), some.column(1).is_null().to_numpy(zero_copy_only=False), size
                    own = int(kernels.mix(np.array([block], U64))[0] % U64(ranges))
                    rows = [(own, 1, ids, size[:0]), (own, 3, h[several], place[several])]
                    for kind, x, y in ((0, h[~several], place[~several]), (2, h[new][count > 1], count[count > 1].astype(np.uint32))):
                        cuts = np.searchsorted((x >> U64(32)) * U64(ranges) >> U64(32), np.arange(ranges + 1))
                        rows += [(i, kind, x[cuts[i] : cuts[i + 1]], y[cuts[i] : cuts[i + 1]]) for i in np.flatnonzero(np.diff(cuts)).tolist()]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([r[0] for r in rows], pa.int32()), pa.array(np.full(len(rows), block)), pa.array([r[1] for r in rows], pa.int32()), _binary([r[2] for r in rows]), _binary([r[3] for r in rows])],
                        ["range", "block", "kind", "a", "b"],
                    )

    return docs.mapInArrow(run, "range int, block long, kind int, a binary, b binary")


SHARED = "block long, kind int, a binary, b binary, c binary"


def _shared(batches):
    """Of each range, the hashes that two documents or more have, by block, with the logarithm of their frequency.

    Kind 0 comes back with places, kind 2 without; kinds 1 and 3 pass."""
    blocks, hashes, values, many = [], [], [], []
    for batch in batches:
        kind = batch.column(2).to_numpy()
        own = batch.column(1).to_numpy()
        for i in range(batch.num_rows):
            if kind[i] in (1, 3):
                yield pa.RecordBatch.from_arrays([batch.column(1).slice(i, 1), batch.column(2).slice(i, 1), batch.column(3).slice(i, 1), batch.column(4).slice(i, 1), pa.array([b""], pa.binary())], ["block", "kind", "a", "b", "c"])
                continue
            a = np.frombuffer(batch.column(3)[i].as_buffer(), U64)
            hashes.append(a.copy())
            values.append(np.frombuffer(batch.column(4)[i].as_buffer(), np.uint32 if kind[i] else np.uint16).astype(np.uint32))
            blocks.append(np.full(len(a), own[i]))
            many.append(np.full(len(a), kind[i] == 2))
    if not hashes:
        return
    h, v, b, m = np.concatenate(hashes), np.concatenate(values), np.concatenate(blocks), np.concatenate(many)
    for x in (hashes, values, blocks, many):
        x.clear()
    order = np.argsort(h)
    s = h[order]
    new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    df = np.repeat(np.add.reduceat(np.where(m, v, 1)[order].astype(np.int64), new), np.diff(np.append(new, len(s))))
    keep = order[df >= 2]
    rank = np.minimum(np.log2(df[df >= 2]) * 4, 255).astype(np.uint8)
    h, v, b, m = h[keep], v[keep], b[keep], m[keep]
    order = np.lexsort((m, b))
    h, v, b, m, rank = h[order], v[order], b[order], m[order], rank[order]
    cuts = np.flatnonzero(np.concatenate([[True], (b[1:] != b[:-1]) | (m[1:] != m[:-1])])) if len(b) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(b))
    for k in range(0, len(cuts), 64):
        x, y = cuts[k : k + 64], ends[k : k + 64]
        yield pa.RecordBatch.from_arrays(
            [pa.array(b[x]), pa.array(np.where(m[x], 2, 0).astype(np.int32)), _binary([h[i:j] for i, j in zip(x, y, strict=True)]), _binary([v[i:j].astype(np.uint16) if not m[i] else v[:0] for i, j in zip(x, y, strict=True)]), _binary([rank[i:j] for i, j in zip(x, y, strict=True)])],
            ["block", "kind", "a", "b", "c"],
        )


DOCS = "rid long, doc_id long, n long, fp long, own long, home long, length long, hashes binary"


def _gathered(batches):
    """For each document of each block: its set's size and, if it can have a link, its shared hashes, rarest first, and the
    last hash of its prefix."""
    ids: dict[int, np.ndarray] = {}
    parts: dict[int, list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = {}
    several: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    ranks: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        block, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        for i in range(batch.num_rows):
            a, b, c = (batch.column(k)[i].as_buffer() for k in (2, 3, 4))
            if kind[i] == 1:
                ids[block[i]] = np.frombuffer(a, ROW).copy()
            elif kind[i] == 3:
                several[block[i]] = np.frombuffer(a, U64).copy(), np.frombuffer(b, np.uint16).copy()
            elif kind[i] == 2:
                ranks.setdefault(block[i], []).append((np.frombuffer(a, U64).copy(), np.frombuffer(c, np.uint8).copy()))
            else:
                parts.setdefault(block[i], []).append((np.frombuffer(a, U64).copy(), np.frombuffer(b, np.uint16).copy(), np.frombuffer(c, np.uint8).copy()))
    for block, rows in ids.items():
        n = rows["n"]
        if block in ranks:
            h, r = (np.concatenate(x) for x in zip(*ranks.pop(block), strict=True))
            order = np.argsort(h)
            own, place = several.pop(block)
            parts.setdefault(block, []).append((own, place, r[order][np.searchsorted(h[order], own)]))
        h, p, r = (np.concatenate(x) for x in zip(*parts.pop(block), strict=True)) if block in parts else (np.zeros(0, U64), np.zeros(0, np.uint16), np.zeros(0, np.uint8))
        order = np.lexsort((h, r, p))
        h, p, r = h[order], p[order], r[order]
        at = np.searchsorted(p, np.arange(len(n) + 1))
        own = n - np.diff(at)
        total = np.concatenate([[U64(0)], np.cumsum(kernels.mix(h ^ U64(0x5851F42D4C957F2D)), dtype=U64)])
        fp = kernels.mix(total[at[1:]] - total[at[:-1]] + n.astype(U64)).astype(np.int64)
        can = (own < prefix(n)) & (n > 0)
        last = np.minimum(at[:-1] + np.maximum(prefix(n) - own, 1), at[1:]) - 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows["rid"]),
                pa.array(rows["doc"], mask=rows["null"]),
                pa.array(n),
                pa.array(fp),
                pa.array(own),
                pa.array(np.concatenate([h, np.zeros(1, U64)])[last].view(np.int64), mask=~can),
                pa.array(8 * np.diff(at)),
                pa.array([h[at[i] : at[i + 1]].tobytes() if can[i] else None for i in range(len(n))], pa.binary()),
            ],
            [c.split()[0] for c in DOCS.split(", ")],
        )


def _prefixes(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(hash, rep, tile) of the shared elements in each prefix; elements of one document alone come first and are left out."""
    rep, tile, n, own = (batch.column(i).to_numpy() for i in range(4))
    hs = [np.frombuffer(h.as_buffer(), U64)[:k] for h, k in zip(batch.column(4), (prefix(n) - own).tolist(), strict=True)]
    size = [len(h) for h in hs]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(hs).view(np.int64)), pa.array(np.repeat(rep, size)), pa.array(np.repeat(tile, size))], ["hash", "rep", "tile"])


def divide_skip(lists: list[list[int]], least: np.ndarray, at_least: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids in at least `least[id]` of the sorted lists, and in how many.

    at_least is the smallest of the bounds. Of the lists, the at most at_least - 1 longest are put aside; an id
    must be in some of the others, which are merged by a heap and counted; the long lists are then probed by binary search.
    """
    if not lists:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    lists = sorted(lists, key=len)
    aside = max(0, min(at_least - 1, int(at_least / (0.01 * math.log2(max(len(lists[-1]), 2)) + 1)), len(lists) - 1))
    short, long = lists[: len(lists) - aside], lists[len(lists) - aside :]
    count = Counter(heapq.merge(*short))
    ids = np.fromiter(count, np.int64, len(count))
    total = np.fromiter(count.values(), np.int64, len(count))
    for left in range(len(long), -1, -1):  # lists that are still to be probed, the longest last
        ok = total + left >= least[ids]
        ids, total = ids[ok], total[ok]
        if not left or not len(ids):
            break
        probe = np.asarray(long[len(long) - left])
        i = np.searchsorted(probe, ids)
        total = total + (probe[np.minimum(i, len(probe) - 1)] == ids)
    return ids, total


class Index:
    """The inverted lists of the sets of a tile: members (rep, n, copies, sorted hashes)."""

    def __init__(self, members: list[tuple[int, int, int, np.ndarray]]):
        self.members = members
        self.n = np.array([m[1] for m in members], np.int64)
        h = np.concatenate([m[3] for m in members])
        who = np.repeat(np.arange(len(members)), [len(m[3]) for m in members])
        order = np.lexsort((who, h))
        h, who = h[order], who[order]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
        self.keys, self.first, self.who = h[first], np.append(first, len(h)), who
        self.made: dict[int, list[int]] = {}

    def list(self, k: int) -> list[int]:
        if k not in self.made:
            self.made[k] = self.who[self.first[k] : self.first[k + 1]].tolist()
        return self.made[k]

    def search(self, size: int, hashes: np.ndarray, after: int = -1) -> np.ndarray:
        """Members behind place `after` that link with a set of `size` elements, of which `hashes` are shared ones."""
        if not len(self.keys):
            return np.zeros(0, np.int64)
        at = np.searchsorted(self.keys, hashes)
        at = at[self.keys[np.minimum(at, len(self.keys) - 1)] == hashes]
        least = -(-4 * (self.n + size) // 9)
        fits = (5 * np.minimum(self.n, size) >= 4 * np.maximum(self.n, size)) & (least <= len(at))
        fits[: after + 1] = False
        if not fits.any():
            return np.zeros(0, np.int64)
        ids, _ = divide_skip([self.list(k) for k in at.tolist()], np.where(fits, least, len(hashes) + 1), int(least[fits].min()))
        return ids


def _tiles(batches):
    """Runs the search of each tile; rows come sorted by tile and chunk, members first. Returns a forest of links, and counts of
    links (b is null)."""
    key, members, index, first = None, [], None, True
    count: dict[int, int] = {}
    parent: dict[int, int] = {}
    rows: list[tuple] = []

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def link(x: tuple, found: np.ndarray):
        for j in found.tolist():
            y = members[j]
            count[x[0]] = count.get(x[0], 0) + y[2]
            count[y[0]] = count.get(y[0], 0) + x[2]
            u, v = root(x[0]), root(y[0])
            if u != v:
                parent[max(u, v)] = min(u, v)
                rows.append((x[0], y[0], 0))

    def indexed():
        nonlocal index
        if index is None:
            index = Index(members)
            if first:  # one of the tasks of a tile compares its members
                for i, m in enumerate(members):
                    link(m, index.search(m[1], m[3], i))
        return index

    def done():
        if members:
            indexed()
        out = rows + [(x, None, c) for x, c in count.items()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], ["a", "b", "links"]) if out else None

    for batch in batches:
        tile, chunk, sent, rep, n, copies = (batch.column(i).to_numpy() for i in range(6))
        for i in range(batch.num_rows):
            if (tile[i], chunk[i]) != key:
                if key is not None and (out := done()):
                    yield out
                key, members, index, first = (tile[i], chunk[i]), [], None, chunk[i] == 0
                count, parent, rows = {}, {}, []
            own = int(rep[i]), int(n[i]), int(copies[i]), np.sort(np.frombuffer(batch.column(6)[i].as_buffer(), U64))
            if sent[i]:
                if members:
                    link(own, indexed().search(own[1], own[3]))
            else:
                members.append(own)
    if key is not None and (out := done()):
        yield out


def join(docs: DataFrame, tile: int = TILE, sent: int = SENT) -> DataFrame:
    """rid, doc_id, n_shingles, n_links (documents linked directly), component_id and `first` for each row of docs (doc_id, text).

    rid is the row's number in common.numbered(docs); first marks one row of each group, that of smallest doc_id.
    """
    return _joined(common.numbered(docs.select("doc_id", "text")), tile, sent)


def _joined(docs: DataFrame, tile: int = TILE, sent: int = SENT) -> DataFrame:
    """join() of numbered rows."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(512, 8 * parts)
    clean = docs.select("rid", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = _spread(clean, ranges).repartition("range").mapInArrow(_shared, SHARED)
    sized = common.cut(out.repartition("block").mapInArrow(_gathered, DOCS), "ngram-sets")

    # equal sets are one class; a set with elements of its own has no equal
    able = sized.where("home is not null").select("rid", "doc_id", "n", "fp", F.when(F.col("own") > 0, F.col("rid")).otherwise(-1).alias("solo"), "own", "home", "length")
    classes = able.groupBy("n", "fp", "solo").agg(F.min("rid").alias("rep"), F.count("*").alias("copies"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("least"), F.min("home").alias("home"), F.max("length").alias("length"))
    classes = common.cut(classes.withColumn("band", F.floor(F.log("n") / math.log(1.25)).cast("long")), "ngram-classes")
    lists = classes.groupBy("home", "band").agg(F.ceil(F.greatest(F.count("*") / tile, F.sum("length") / SIZE)).alias("parts"))
    # sets that link are of one band or of neighbouring ones; the last byte of a tile is its band
    at = F.xxhash64("home", "band", F.pmod(F.xxhash64("rep"), F.col("parts"))).bitwiseAND(F.lit(~255)).bitwiseOR(F.col("band"))
    placed = common.join_hot(classes.select("rep", "copies", "home", "band"), lists, ["home", "band"], "rep").select("rep", "copies", at.alias("tile"))
    reps = common.cut(sized.where("home is not null").join(placed, F.col("rid") == F.col("rep")).select("rep", "tile", "n", "own", "copies", "hashes"), "ngram-reps")

    listed = common.arrow_map(reps.select("rep", "tile", "n", "own", "hashes"), _prefixes, "hash long, rep long, tile long")
    several = listed.groupBy("hash").agg(F.min("tile").alias("x"), F.max("tile").alias("y")).where("x <> y").select("hash")
    targets = listed.select("hash", F.col("tile").alias("to")).distinct().join(several, "hash")
    band = lambda c: F.col(c).bitwiseAND(F.lit(255))
    one_way = (F.xxhash64(F.least("tile", "to"), F.greatest("tile", "to")) % 2 == 0) == (F.col("tile") < F.col("to"))
    routes = common.join_hot(listed, targets, ["hash"], "rep").where((F.col("tile") != F.col("to")) & (F.abs(band("tile") - band("to")) <= 1) & one_way).select("rep", "to").distinct()
    routes = common.cut(routes, "ngram-routes")
    chunks = routes.groupBy(F.col("to").alias("tile")).agg(F.ceil(F.count("*") / sent).cast("int").alias("chunks"))
    members = common.join_hot(reps.drop("own"), chunks, ["tile"], "rep", "left").select(
        "tile", F.explode(F.sequence(F.lit(0), F.coalesce("chunks", F.lit(1)) - 1)).alias("chunk"), F.lit(0).alias("sent"), "rep", "n", "copies", "hashes"
    )
    guests = common.join_hot(routes.withColumnRenamed("to", "tile"), chunks, ["tile"], "rep").select("rep", "tile", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int").alias("chunk"))
    guests = guests.join(reps.drop("tile", "own"), "rep").select("tile", "chunk", F.lit(1).alias("sent"), "rep", "n", "copies", "hashes")
    found = common.cut(members.union(guests).repartition("tile", "chunk").sortWithinPartitions("tile", "chunk", "sent").mapInArrow(_tiles, "a long, b long, links long"), "ngram-links")
    links = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    group = common.components(found.where("b is not null").select("a", "b"), "a", "b", "ngram-cc")

    known = common.named(classes.select("n", "fp", "solo", "rep", "copies", "least").join(links, "rep", "left"), group, "rep", "least")
    rows = common.join_hot(able.select("rid", "doc_id", "n", "fp", "solo"), known.select("n", "fp", "solo", "copies", "links", "_least"), ["n", "fp", "solo"], "rid")
    rows = rows.select("rid", "doc_id", F.col("n").alias("n_shingles"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.col("_least.doc_id").alias("component_id"), (F.col("_least.rid") == F.col("rid")).alias("first"))
    return rows.union(sized.where("home is null").select("rid", "doc_id", "n", F.lit(0).cast("long"), "doc_id", F.lit(True)))


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of docs, with all their columns, that are the first of their group; every other one has a near-duplicate that stays
    or is linked with one through others."""
    rid = common.free_name(docs, "rid")
    rows = common.numbered(docs, rid)
    first = _joined(rows.select(F.col(rid).alias("rid"), "doc_id", "text")).where("first").select(F.col("rid").alias(rid))
    return rows.join(first, rid, "left_semi").select(*[f"`{c}`" for c in docs.columns])


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(common.table(spark, sf_dir, "documents").select("doc_id", "text")).drop("rid", "first")
