"""Substring dedup by prefix-partitioned suffix trees: windows of `size` words that an earlier document has too are removed.

A suffix tree of the corpus splits into subtrees by what its strings begin with. Only strings of `size` words matter, and only
those that two documents have, so not every suffix is sent about:

1. A window is filed under its rarest-looking run of GRAM words, that of the smallest hash, the first of equal ones.
   Neighbouring windows mostly share this run; such a stretch of windows is a piece, about one for 22 words. A piece goes out as
   two hashes: its key (the run) and its content. Equal windows have equal keys.
2. Of equal pieces only one of the smallest document is kept; all windows of the others, if of a larger document, are
   removed, and what is found below for the one holds for those of its document. A key with pieces of one document alone, or one kind of piece, ends here: most do.
3. The pieces of the other keys are fetched with their words. The key is the first prefix that splits the strings into groups. A
   group with more than `hot` different pieces would not fit a task and is split by a longer prefix: the
   words that all windows have in which the run stands at about one place (43 of 50 words), then all words. Prefixes
   are so long where strings are frequent, and only there; at each length step 2 is done again.
4. Each group that fits is one subtree: the windows of its pieces in suffix order, with the lengths of common prefixes of neighbours.
   Its internal nodes that are `size` words deep or more are the repeats; below each one, windows of other
   documents than the smallest go. Words are compared as hashes of 64 bits.

Documents are ordered by doc_id, those without one after all others. Rows are told apart by their place in the table:
repeated rows, and rows that share a doc_id, are no earlier documents of one another, but all lose what a smaller one has. All
words that a removed window covers go; windows are judged on the input, and overlaps count. Null and empty texts have no words.
Texts of fewer than `size` words lose none. Very long texts are read in segments. Ties do not occur. An empty table gives no rows. Other
columns, of whatever name, are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, kernels

SIZE, GRAM, HOT = 50, 8, 500
#: Windows whose run stands within so many words of one another share a prefix, at each length of prefix after the first.
LADDER = (8, 1)
STEP = 1 << 19
U64 = np.uint64
_MASK = U64((1 << 20) - 1)
#: Bytes of words whose suffix order is made at once, if they are of several groups.
TREE = 2 << 20


def _min_filter(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` entries."""
    m, w = h, 1
    while 2 * w <= width:
        m = np.minimum(m[:-w], m[w:])
        w *= 2
    return np.minimum(m[: len(m) - (width - w)], m[width - w :]) if width > w else m


def _sums(w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums from which hashes of runs of words come, and the factors that make them independent of place."""
    p, q = kernels.powers(len(w) + 1)
    c = np.zeros(len(w) + 1, U64)
    np.cumsum(w * p[: len(w)], out=c[1:])
    return c, q


def _runs(sums: tuple[np.ndarray, np.ndarray], first: np.ndarray, end: np.ndarray) -> np.ndarray:
    c, q = sums
    return kernels.mix((c[end] - c[first]) * q[first] + (end - first).astype(U64))


def pieces(w: np.ndarray, count: np.ndarray, size: int = SIZE) -> list[np.ndarray]:
    """Of words by text: (text, key, content, first word, windows, place of the run in the first window) of each piece."""
    gram = min(GRAM, size)
    text, begin = np.repeat(np.arange(len(count)), count), np.cumsum(count) - count
    out = []
    for at in range(0, len(w) - size + 1, STEP):
        b, own = w[at : at + STEP + size - 1], text[at : at + STEP + size - 1]
        sums = _sums(b)
        place = np.arange(len(b) - gram + 1)
        h = _runs(sums, place, place + gram)
        run = (_min_filter((h & ~_MASK) | place.astype(U64), size - gram + 1) & _MASK).astype(np.int64)
        n = len(run)
        good = own[:n] == own[size - 1 :]  # of one text
        new = np.concatenate([[True], (run[1:] != run[:-1]) | (own[1:n] != own[: n - 1]) | (good[1:] != good[:-1])])
        first = np.flatnonzero(new)
        windows = np.diff(np.append(first, n))
        first, windows = first[good[first]], windows[good[first]]
        p = run[first]
        out.append((own[first], h[p], _runs(sums, first, first + windows + size - 1), first + at - begin[own[first]], windows, p - first))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64), *[np.zeros(0, U64)] * 2, *[np.zeros(0, np.int64)] * 3]


def longer(w: np.ndarray, n: int, off: int, width: int, size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """A piece of n windows split by a longer prefix: (key, content, first window, windows, place of the run) of each part.

    The run stands at off in the first window, one place earlier in each next one. Parts are windows in which it stands at places
    of one multiple of `width`; their key is what all such windows have, so it is the same wherever they stand.
    """
    out, sums = [], _sums(w)
    k = 0
    while k < n:
        o = off - k
        low = o // width * width  # the last window of the part has the run at `low`, at most `width` - 1 places earlier than its first
        m = min(o - low + 1, n - k)
        a = k + o - low  # where the window of the smallest place begins
        ends = np.array([[a, a + size - width + 1], [k, k + m + size - 1]])
        key, content = _runs(sums, ends[:, 0], ends[:, 1]).view(np.int64).tolist()
        out.append((key, content, k, m, o))
        k += m
    return out


PIECE = "key long, content long, ord long, rid long, root long, at long, n int, off int"


def _filed(rows: DataFrame, size: int) -> DataFrame:
    def run(part: pa.RecordBatch) -> pa.RecordBatch | None:
        w, _, _, count = kernels.words(*kernels.packed(part.column(2)), table=kernels.TABLE)
        own, key, content, at, n, off = pieces(w, count, size)
        if not len(own):
            return None
        rid, order = (part.column(i).to_numpy()[own] for i in (0, 1))
        made = key.view(np.int64), content.view(np.int64), order, rid, np.zeros_like(at), at, n.astype(np.int32), off.astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(x) for x in made], NAMES[:-2])

    return common.arrow_map(rows.select("rid", "ord", "text"), run, PIECE, "text")


FETCHED = PIECE + ", kinds long, words binary"
NAMES = [c.split()[0] for c in FETCHED.split(", ")]
TYPES = [*[pa.int64()] * 6, *[pa.int32()] * 2, pa.int64(), pa.binary()]


def _batch(made: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), TYPES, strict=True)], NAMES)


def _fetched(rows: DataFrame, asked: DataFrame, size: int) -> DataFrame:
    """The asked-for pieces with their words, single spaces between."""

    def run(batches):
        for batch in batches:
            for part in common.by_bytes(batch, "text"):
                made = []
                for k in range(part.num_rows):
                    want = part.column(3)[k].as_py()
                    for first, words, end in _segments(part.column(2)[k].as_buffer().to_pybytes(), 1 << 20, max(q["n"] for q in want) + size):
                        for q in want:
                            if first <= q["at"] < end:
                                i = q["at"] - first
                                made.append((q["key"], q["content"], part.column(1)[k].as_py(), part.column(0)[k].as_py(), 0, q["at"], q["n"], q["off"], q["kinds"], b" ".join(words[i : i + q["n"] + size - 1])))
                if made:
                    yield _batch(made)

    each = asked.groupBy("rid").agg(F.collect_list(F.struct("key", "content", "at", "n", "off", "kinds")).alias("want"))  # of one text
    return rows.select("rid", "ord", "text").join(each, "rid").mapInArrow(run, FETCHED)


def _segments(data: bytes, size: int, ahead: int = 0):
    """(number of the first word, words, number behind the last word that begins in the segment) of parts of a text of about `size`
    bytes, each with `ahead` words of what follows."""
    first, at = 0, 0
    while at < len(data):
        end = at + size
        if end < len(data):
            while end < len(data) and not kernels.SPACE[data[end]]:
                end += 1
        own = data[at:end].split()
        more, far = [], end
        while len(more) < ahead and far < len(data):  # words ahead, from as much text as has them
            to = far + 16 * ahead
            while to < len(data) and not kernels.SPACE[data[to]]:
                to += 1
            more += data[far:to].split()
            far = to
        yield first, own + more[:ahead], first + len(own)
        first, at = first + len(own), end


def _split(open_: DataFrame, width: int, size: int) -> DataFrame:
    """Pieces by a longer prefix, with their words; root is the first word of the piece they were part of."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rid, order, at, n, off = (batch.column(i).to_pylist() for i in range(5))
        made = []
        for k in range(batch.num_rows):
            data = batch.column(5)[k].as_buffer().to_pybytes()
            w = kernels.words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), table=kernels.TABLE)[0]
            words = data.split()
            for key, content, i, m, o in longer(w, n[k], off[k], width, size):
                made.append((key, content, order[k], rid[k], at[k], at[k] + i, m, o, 0, b" ".join(words[i : i + m + size - 1])))
        return _batch(made)

    return common.arrow_map(open_.select("rid", "ord", "at", "n", "off", "words"), run, FETCHED)


def subtree(words: np.ndarray, length: np.ndarray, windows: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """The internal nodes, `size` deep or more, of the suffix tree of pieces: (node, place in order of pieces) of their windows.

    words: hashes of the words of all pieces; length: words of each; windows: how many suffixes of each begin a window.
    """
    ids = np.unique(words, return_inverse=True)[1].astype(np.int64)
    begin = np.cumsum(length) - length
    # a sign of its own ends each piece, so that no string goes on into the next one
    text = np.insert(ids, begin + length, len(ids) + np.arange(len(length)))
    start = begin + np.arange(len(length))
    levels, have = [text], 1
    while have < size:  # order of all suffixes up to 1, 2, 4 ... words
        r = levels[-1]
        there = np.concatenate([r[have:], np.zeros(have, np.int64)]) if have < len(r) else np.zeros(len(r), np.int64)
        levels.append(np.unique(r * (int(there.max()) + 1) + there, return_inverse=True)[1].astype(np.int64))
        have *= 2
    at = np.repeat(start, windows) + np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    order = np.argsort(levels[-1][at], kind="stable")
    a, b = at[order][:-1].copy(), at[order][1:].copy()
    common_ = np.zeros(len(a), np.int64)  # words that neighbours in suffix order have in common
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < len(text)) & (b < len(text))
        same = inside & (levels[k][np.minimum(a, len(text) - 1)] == levels[k][np.minimum(b, len(text) - 1)])
        common_[same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    node = np.concatenate([[0], np.cumsum(common_ < size)]) if len(order) else np.zeros(0, np.int64)
    return node, order


def repeated(blobs: list[bytes], order: np.ndarray, windows: np.ndarray, size: int = SIZE) -> list[np.ndarray]:
    """For each piece of one or more whole groups, which of its windows a smaller document has."""
    w, _, _, count = kernels.words(np.frombuffer(b"".join(blobs), np.uint8), np.concatenate([[0], np.cumsum([len(x) for x in blobs])]), table=kernels.TABLE)
    node, place = subtree(w, count, windows, size)
    document = np.repeat(order, windows)
    gone = np.zeros(len(document), bool)
    if len(place):
        first = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        gone[place] = document[place] > np.minimum.reduceat(document[place], first)[node]
    return np.split(gone, np.cumsum(windows)[:-1])


def _trees(size: int):
    """Spans of repeated windows; rows come sorted by key, with whole groups."""

    def judged(rows: list[tuple]) -> pa.RecordBatch | None:
        out = []
        for (_, _, rid, at, _, _), gone in zip(rows, repeated([r[5] for r in rows], np.array([r[1] for r in rows]), np.array([r[4] for r in rows]), size), strict=True):
            d = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
            out += [(rid, at, at + i, j - i) for i, j in zip(np.flatnonzero(d == 1).tolist(), np.flatnonzero(d == -1).tolist(), strict=True)]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.int32()))], ["rid", "root", "at", "n"]) if out else None

    def run(batches):
        rows, bytes_ = [], 0
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for row in zip(*columns, strict=True):
                if bytes_ > TREE and rows[-1][0] != row[0]:
                    if (out := judged(rows)) is not None:
                        yield out
                    rows, bytes_ = [], 0
                rows.append(row)
                bytes_ += len(row[5])
        if rows and (out := judged(rows)) is not None:
            yield out

    return run


def _found(pieces: DataFrame, size: int, hot: int, widths: tuple[int, ...], fetch: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """rid, root, at, n of the windows of pieces that a smaller document has.

    fetch adds the words to pieces that are asked for; widths: the longer prefixes that are left for groups of more than `hot`.
    """
    kinds = common.cut(pieces.groupBy("key", "content").agg(F.min(F.struct("ord", "rid", "at", "n", "off")).alias("least"), F.max("ord").alias("top")), "substring-kinds")
    several = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.min("least.ord").alias("low"), F.max("least.ord").alias("high")).where("kinds > 1 and low < high")
    # one piece of each kind, where pieces that are not equal may still have windows in common
    left = common.cut(kinds.select("key", "content", "least.*").join(several.select("key", "kinds"), "key"), "substring-left")
    open_ = common.cut(fetch(left), "substring-open")
    small = open_.where(F.col("kinds") <= hot).select("key", "ord", "rid", "at", "n", "words").repartition("key").sortWithinPartitions("key")
    found = small.mapInArrow(_trees(size), "rid long, root long, at long, n int")
    large = open_.where(F.col("kinds") > hot)
    if widths and large.limit(1).count():
        split = common.cut(_split(large, widths[0], size), "substring-split")
        again = lambda left: split.drop("kinds").join(left.select("key", "content", "rid", "at", "kinds"), ["key", "content", "rid", "at"]).select(*NAMES)
        found = found.union(_found(split, size, hot, widths[1:], again))
    # what was found for one piece holds for all equal ones of its document, and larger ones lose all windows
    runs = found.join(left.select("key", "content", "rid", F.col("at").alias("root"), F.col("ord").alias("_ord")), ["rid", "root"])
    runs = runs.groupBy("key", "content", "_ord").agg(F.collect_list(F.struct((F.col("at") - F.col("root")).alias("k"), "n")).alias("runs"))  # of one piece
    copied = kinds.where("least.ord < top").select("key", "content", F.col("least.ord").alias("_ord"), F.lit(None).cast("array<struct<k:bigint,n:int>>").alias("runs"))
    all_ = F.array(F.struct(F.lit(0).cast("long").alias("k"), "n"))
    gone = F.when(F.col("runs").isNull(), F.when(F.col("ord") > F.col("_ord"), all_)).when(F.col("ord") == F.col("_ord"), F.col("runs"))
    spans = pieces.join(copied.union(runs), ["key", "content"]).select("rid", "root", "at", F.explode(gone).alias("x"))
    return spans.select("rid", "root", (F.col("at") + F.col("x.k")).alias("at"), "x.n")


def dedup(docs: DataFrame, size: int = SIZE, hot: int = HOT, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, n_spans, kept_sha256 (and the kept words) of every row of docs (doc_id, text)."""
    rows = common.numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")))
    rows = rows.select("rid", "doc_id", F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("ord"), F.coalesce("text", F.lit("")).alias("text"))
    spans = _found(common.cut(_filed(rows, size), "substring-pieces"), size, hot, LADDER, lambda left: _fetched(rows, left, size))
    each = common.cut(spans.groupBy("rid").agg(F.collect_list(F.struct("at", "n")).alias("gone")), "substring-spans")  # of one text

    def cut_out(part: pa.RecordBatch) -> pa.RecordBatch:
        made = []
        for k in range(part.num_rows):
            data, gone = part.column(1)[k].as_buffer().to_pybytes(), part.column(2)[k]
            at = np.array([(g["at"], g["at"] + g["n"] + size - 1) for g in gone.as_py()] if gone.is_valid else np.zeros((0, 2)), np.int64)
            runs: list[list[int]] = []
            for a, z in at[np.argsort(at[:, 0], kind="stable")].tolist():
                if runs and a <= runs[-1][1]:
                    runs[-1][1] = max(runs[-1][1], z)
                else:
                    runs.append([a, z])
            n, removed, sha, kept, space = 0, 0, hashlib.sha256(), [], b""
            for first, words, end in _segments(data, 1 << 20):
                own, place = [], first
                for a, z in runs:
                    if z > first and a < end:
                        own += words[place - first : max(a, place) - first]
                        removed += min(z, end) - max(a, first)
                        place = min(z, end)
                own += words[place - first :]
                if own:
                    some = space + b" ".join(own)
                    sha.update(some)
                    if with_text:
                        kept.append(some)
                    space = b" "
                n = end
            made.append((n, removed, len(runs), sha.hexdigest(), b"".join(kept).decode("utf-8", "replace") if with_text else None))
        types = [pa.int64()] * 3 + [pa.string()] * (1 + with_text)
        out = [pa.array([r[i] for r in made], t) for i, t in enumerate(types)]
        return pa.RecordBatch.from_arrays([part.column(0), *out], ["doc_id", "n_words", "n_removed", "n_spans", "kept_sha256", "text"][: 1 + len(types)])

    rows = rows.select("rid", "doc_id", "text").join(each, "rid", "left").select("doc_id", "text", "gone")
    return common.arrow_map(rows, cut_out, "doc_id long, n_words long, n_removed long, n_spans long, kept_sha256 string" + ", text string" * with_text, "text")


def op12_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), win AS (
  SELECT r, doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM t WHERE len(w) >= 50)
), low AS (
  SELECT h, min(doc_id) AS least FROM win GROUP BY h HAVING count(*) > 1
), gone AS (
  SELECT r, list(i) AS places FROM win JOIN low USING (h) WHERE least < coalesce(doc_id, 9223372036854775807) GROUP BY r
), words AS (
  SELECT r, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM t
), starts AS (
  SELECT r, unnest(places) AS i FROM gone
), marked AS (
  SELECT words.r, word, k, starts.i AS s FROM words ASOF LEFT JOIN starts ON words.r = starts.r AND words.k >= starts.i
), kept AS (
  SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS s FROM marked WHERE s IS NULL OR k > s + 49 GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(s, '')) AS kept_sha256 FROM t LEFT JOIN kept USING (r)
"""
