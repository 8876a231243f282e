"""Benchmark decontamination: pairs of words as seeds, counted, then Smith-Waterman alignment of words.

Words are runs of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased. An item is aligned locally: 2 for an equal
word, -1 for another one, -1 for one left out. The score is divided by that of the whole item, so edited, shortened and
reordered-by-a-few copies still score; a document holds an item from `threshold` on, if at least `least` words are equal
(all words of an item that has fewer). Items of fewer than FEW words are too short for an alignment to tell; they are held where
all their words stand in a row, with score 1. Items without words are never held.

No alignment that scores is missed. Its equal words are at most 2 apart, in item and document, at k places at least, where
k is threshold * words of the item - 1: were fewer so near, the words between would cost more. So pairs of words that are 1 or
2 apart, in that order, are the seeds. Of each item the k / 2 places whose pairs stand in most items are left out, and a window
opens where the other k / 2 seeds are met within the length that an alignment can have; it reaches as far to both
sides. Windows of one item that overlap are one. A very long one is aligned in pieces that overlap by the length of
an alignment, and alignments are done for so many windows at a time that their cells are bounded: memory depends neither on
the text's length nor on how often it repeats an item.

Items are shipped to the executors in blocks of bounded size, every block against all documents; nothing else is
collected. Null and empty texts hold nothing, nor do null items. Rows are told apart by their place in the table: rows
that are repeated, share a doc_id or have none each give rows of their own, and so do items that stand twice. Items with a
null item_id count like others. Of equal alignments of a document the first counts. Without documents or items there
are no rows. Other columns, of whatever name, are never read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, kernels

LEAST, FEW, THRESHOLD, BLOCK = 8, 5, 0.4, 8 << 20
#: Cells of the windows that are aligned at once.
AREA = 1 << 19
U64 = np.uint64


def _pairs(w: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of two words of a text that are 1 or 2 apart, and the place of the first in w."""
    end, at = np.repeat(np.cumsum(count), count), np.arange(len(w))
    first = [np.flatnonzero(at + d < end) for d in (1, 2)]
    made = [kernels.mix(w[j] * U64(0xD6E8FEB86659FD93) + w[j + d] * U64(0xA0761D6478BD642F)) for d, j in zip((1, 2), first, strict=True)]
    return np.concatenate(made), np.concatenate(first)


def _rows_of(w: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words."""
    h = w[: max(0, len(w) - n + 1)]
    for i in range(1, n):
        h = kernels.mix(h * U64(0xE7037ED1A0B428DB) + w[i : i + len(h)])
    return h


class Items:
    """A block of test items: their words, and their seeds as sorted hashes with a bit table in front."""

    def __init__(self, rows: list[tuple[int, str]], threshold: float = THRESHOLD):
        w, _, _, count = kernels.words(*kernels.packed(pa.array([t for _, t in rows], pa.string())), space=kernels.SIGNS)
        at = np.concatenate([[0], np.cumsum(count)])
        keep = [k for k in range(len(rows)) if count[k] >= FEW]
        self.ids = [rows[k][0] for k in keep]
        self.phrases: dict[int, tuple[np.ndarray, list[int]]] = {}
        for n in range(1, FEW):
            own = np.flatnonzero(count == n)
            if len(own):
                h = np.concatenate([_rows_of(w[at[k] : at[k + 1]], n) for k in own])
                order = np.argsort(h, kind="stable")
                self.phrases[n] = h[order], [rows[k][0] for k in own[order]]
        self.words = [w[at[k] : at[k + 1]] for k in keep]
        size = np.array([len(x) for x in self.words], np.int64)
        k = np.maximum(1, np.ceil(threshold * size - 1 - 1e-9)).astype(np.int64)
        self.need = k - k // 2
        self.span = np.ceil(size + 2 * size * max(0, 1 - threshold)).astype(np.int64)  # equal words, and as many others as the score allows
        w = np.concatenate(self.words) if len(size) else np.zeros(0, U64)
        gram, place = _pairs(w, size)
        item = np.repeat(np.arange(len(size)), size)
        once = np.unique(np.stack([gram, item[place].astype(U64)]), axis=1)[0]  # a pair once for each item
        unique, shared = np.unique(once, return_counts=True)
        common = np.zeros(len(w), np.int64)
        np.maximum.at(common, place, shared[np.searchsorted(unique, gram)])
        order = np.lexsort((-common, item))
        left = np.ones(len(w), bool)
        left[order] = np.arange(len(w)) - np.repeat(np.cumsum(size) - size, size) >= np.repeat(k // 2, size)
        both = np.unique(np.stack([gram, item[place].astype(U64)])[:, left[place]], axis=1)
        self.gram, self.item = both[0], both[1].astype(np.int64)
        self.unique = np.unique(self.gram)
        self.front = np.zeros(1 << 20, bool)
        self.front[(self.unique >> U64(44)).astype(np.int64)] = True

    def hits(self, grams: np.ndarray) -> np.ndarray:
        """Places in grams where one of ours stands."""
        at = np.flatnonzero(self.front[(grams >> U64(44)).astype(np.int64)])
        if not len(at) or not len(self.unique):
            return at[:0]
        k = np.minimum(np.searchsorted(self.unique, grams[at]), len(self.unique) - 1)
        return at[self.unique[k] == grams[at]]


    def stated(self, w: np.ndarray, count: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(text, item_id, first word, words) where a phrase first stands in a text."""
        text, begin, out = np.repeat(np.arange(len(count)), count), np.cumsum(count) - count, []
        for n, (known, ids) in self.phrases.items():
            h = _rows_of(w, n)
            k = np.searchsorted(known, h)
            place = np.flatnonzero((known[np.minimum(k, len(known) - 1)] == h) & (text[: len(h)] == text[n - 1 : n - 1 + len(h)]))
            first = np.unique(np.stack([text[place], k[place]]), axis=1, return_index=True)[1] if len(place) else place
            for p in place[first].tolist():
                j = int(k[p])
                while j < len(known) and known[j] == h[p]:  # items that are the same phrase
                    out.append((int(text[p]), ids[j], p - int(begin[text[p]]), n))
                    j += 1
        return out


def align(item: np.ndarray, windows: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
    """Smith-Waterman of an item with each window: (score, equal words, first word, end word) of the best alignment.

    Of equal scores the one that starts first, then the one with more equal words.
    """
    width, n = max(len(x) for x in windows), len(item)
    grid = np.zeros((len(windows), width), U64)
    there = np.zeros((len(windows), width), bool)
    for k, x in enumerate(windows):
        grid[k, : len(x)], there[k, : len(x)] = x, True
    ramp = np.arange(width)
    # a cell holds (score, width - first word, equal words) as one number
    one, far = np.int64(n + 1), np.int64((n + 1) * (width + 1))
    fresh = np.broadcast_to((width - ramp) * one, grid.shape)
    row = np.zeros(grid.shape, np.int64)
    best, end = np.zeros(len(windows), np.int64), np.zeros(len(windows), np.int64)
    for word in item:
        diagonal = np.empty_like(row)
        diagonal[:, 0] = 0
        diagonal[:, 1:] = row[:, :-1]
        diagonal = np.where(diagonal >= far, diagonal, fresh)
        cell = np.where((grid == word) & there, diagonal + 2 * far + 1, diagonal - far)
        cell = np.maximum(cell, row - far)
        cell = np.maximum.accumulate(cell + ramp * far, axis=1) - ramp * far
        row = np.where((cell >= far) & there, cell, 0)
        at = row.argmax(axis=1)
        top = row[np.arange(len(windows)), at]
        better = top > best
        best[better], end[better] = top[better], at[better] + 1
    return [(b // int(far), b % int(one), width - b % int(far) // int(one) if b else 0, e) for b, e in zip(best.tolist(), end.tolist(), strict=True)]


def pieces(windows: list[tuple[int, int, int]], span: int) -> list[tuple[int, int, int]]:
    """Windows (document, first, end) with the long ones cut, so that each run of `span` words is whole in one of them."""
    out = []
    for d, a, z in windows:
        while z - a > 4 * span:
            out.append((d, a, a + 4 * span))
            a += 3 * span
        out.append((d, a, z))
    return out


def batches(windows: list[tuple[int, int, int]], area: int = AREA):
    """Lists of windows of similar length that have about `area` cells at most."""
    own: list[tuple[int, int, int]] = []
    for w in sorted(windows, key=lambda x: x[2] - x[1]):
        if own and (len(own) + 1) * (w[2] - w[1]) > area:
            yield own
            own = []
        own.append(w)
    if own:
        yield own


FOUND = "rid long, doc_id long, item_id long, score double, equal_words long, first_byte long, end_byte long"


def matches(docs: DataFrame, items: Items, threshold: float, least: int = LEAST) -> DataFrame:
    def run(part: pa.RecordBatch) -> pa.RecordBatch | None:
        buf, off = kernels.packed(part.column(2))
        w, s, e, count = kernels.words(buf, off, space=kernels.SIGNS)
        s, e, at = s - np.repeat(off[:-1], count), e - np.repeat(off[:-1], count), np.concatenate([[0], np.cumsum(count)])
        rows = [(d, item, 1.0, n, int(s[at[d] + a]), int(e[at[d] + a + n - 1])) for d, item, a, n in items.stated(w, count)]
        grams, place = _pairs(w, count)
        hit = items.hits(grams)
        if not len(hit) and not rows:
            return None
        lo, hi = np.searchsorted(items.gram, grams[hit], "left"), np.searchsorted(items.gram, grams[hit], "right")
        k = np.repeat(np.arange(len(hit)), hi - lo)
        g = np.arange(len(k)) - np.repeat(np.cumsum(hi - lo) - (hi - lo), hi - lo) + np.repeat(lo, hi - lo)
        item, place = np.divmod(np.unique(items.item[g] * len(w) + place[hit[k]]), len(w))
        doc = np.searchsorted(at, place, "right") - 1
        to = np.arange(len(place)) + items.need[item] - 1
        there = to < len(place)
        to = np.minimum(to, len(place) - 1)
        met = np.flatnonzero(there & (item[to] == item) & (doc[to] == doc) & (place[to] - place <= items.span[item]))
        doc, item, place = doc[met], item[met], place[met] - at[doc[met]]
        first, last = np.maximum(place - items.span[item], 0), np.minimum(place + items.span[item] + 1, count[doc])
        windows: dict[int, list[tuple[int, int, int]]] = {}
        for d, i, a, z in zip(doc.tolist(), item.tolist(), first.tolist(), last.tolist(), strict=True):
            own = windows.setdefault(i, [])
            if own and own[-1][0] == d and a < own[-1][2]:
                own[-1] = d, own[-1][1], max(z, own[-1][2])
            else:
                own.append((d, a, z))
        for i, own in windows.items():
            n = len(items.words[i])
            best: dict[int, tuple] = {}
            for some in batches(pieces(own, int(items.span[i]))):
                got = align(items.words[i], [w[at[d] + a : at[d] + z] for d, a, z in some])
                for (d, a, _), (score, equal, x, y) in zip(some, got, strict=True):
                    if score >= threshold * 2 * n and equal >= min(least, n):
                        new = score, -(a + x), equal, a + x, a + y
                        best[d] = max(best.get(d, new), new)
            rows += [(d, items.ids[i], b[0] / (2 * n), b[2], int(s[at[d] + b[3]]), int(e[at[d] + b[4] - 1])) for d, b in best.items()]
        if not rows:
            return None
        d, *rest = zip(*rows, strict=True)
        types = pa.int64(), pa.float64(), pa.int64(), pa.int64(), pa.int64()
        names = [c.split()[0] for c in FOUND.split(", ")]
        return pa.RecordBatch.from_arrays([part.column(0).take(pa.array(d)), part.column(1).take(pa.array(d)), *(pa.array(c, t) for c, t in zip(rest, types, strict=True))], names)

    return common.arrow_map(docs.select("rid", "doc_id", "text"), run, FOUND, "text")


def find(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """rid, doc_id, item_id, score, equal_words and the bytes of the passage, a row for each item that a document holds.

    rid is the row's number in common.numbered(docs). block: bytes of test items that are shipped at once.
    """
    return _found(common.numbered(docs.select("doc_id", "text")), benchmark, threshold, block)


def _found(docs: DataFrame, benchmark: DataFrame, threshold: float, block: int = BLOCK) -> DataFrame:
    """find() in numbered rows."""
    docs = docs.select("rid", F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    blocks = max(1, -(-int(items.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block))
    out = None
    for k in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k).orderBy("item_id", "text").collect()
        own = Items([(r.item_id, r.text) for r in rows], threshold)
        found = matches(docs, own, threshold)
        out = found if out is None else out.union(found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that hold no item."""
    rid = common.free_name(docs, "rid")
    rows = common.numbered(docs, rid)
    found = _found(rows.select(F.col(rid).alias("rid"), "doc_id", "text"), benchmark, threshold).select(F.col("rid").alias(rid)).distinct()
    return rows.join(found, rid, "left_anti").select(*[f"`{c}`" for c in docs.columns])


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "benchmark")).drop("rid")
