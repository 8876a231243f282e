"""Suffix-array dedup of repeated byte strings by longest-previous-factor arrays.

Every string of `size` bytes that starts at two places of the corpus is found exactly. One global suffix array would
need every suffix in one order; here the strings are first dealt by content, so that equal ones always meet:

1. The key of a string is the smallest hash of its 64-byte pieces. Neighbouring strings mostly have one key; such a
   run of strings is its context. One pass over the texts sends key, hash and place of each context, about one for 70
   bytes, in byte blocks by range of mixed keys, which are even; of equal contexts of a batch, one. A very common context costs a range an entry
   for each batch, not for each document.
2. Contexts that are wholly equal to another one are duplicates at once. If a key has different contexts, or one that
   repeats itself, the first of each kind is asked for with its bytes. Keys without a second context end here.
3. The asked-for contexts of a key come together. They are put into suffix order up to `size` bytes by prefix doubling;
   previous and next smaller positions in that order give the longest previous (and, turned round, next) factor of each
   string. A string whose factor reaches `size` is repeated.
4. A key with more than `hot` different contexts would burden one task. Its strings are dealt singly by hash instead,
   which evens out, and those with an equal are repeated.

Contexts are told apart by hashes of 64 bits; within a key all else is decided by the suffix order of bytes.

keep="first" removes a repeated string except where it comes first (by row, then place); keep="none" removes all
its places. All bytes that a removed string covers go; strings are judged on the input. Matches do not cross documents.
Null and empty texts, and texts below `size` bytes, lose nothing. Very long texts are read in segments. Rows are told apart
by their place in the table, not by doc_id: repeated rows, rows that share a doc_id and those without one are documents of
their own, in the order of common.numbered(). Ties do not occur.
An empty table gives no rows. Other columns, of whatever name, are never read. Cut characters decode with U+FFFD.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, kernels

SIZE, PIECE, HOT = 200, 64, 1000
U64 = np.uint64


def _min_filter(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of `width` entries."""
    m, w = h, 1
    while 2 * w <= width:
        m = np.minimum(m[:-w], m[w:])
        w *= 2
    return np.minimum(m[: len(m) - (width - w)], m[width - w :]) if width > w else m


def contexts(buf: np.ndarray, off: np.ndarray, size: int = SIZE):
    """Runs of strings of one key: (key, hash, text, first byte in the text, strings, whether it may repeat itself)."""
    out, piece = [], min(PIECE, size)
    step = kernels.SEGMENT
    p, q = kernels.powers(step + size + 1)
    for at in range(0, max(0, len(buf) - size + 1), step):
        b = buf[at : at + step + size - 1]
        c = np.zeros(len(b) + 1, U64)
        np.cumsum(kernels.TABLE[b] * p[: len(b)], out=c[1:])
        h = kernels.mix((c[piece:] - c[:-piece]) * q[: len(b) - piece + 1])
        m = _min_filter(h, size - piece + 1)
        n = len(m)
        lo, hi = (int(x) for x in np.searchsorted(off, [at, at + n - 1], "right") - 1)
        good = np.ones(n, bool)
        edges = off[lo + 1 : hi + 2] - at
        for e in edges:  # strings that would cross the end of a text
            good[max(0, e - size + 1) : max(0, e)] = False
        eq = np.concatenate([[0], np.cumsum(h[:n] == m)])
        new = np.ones(n, bool)
        new[1:] = (m[1:] != m[:-1]) | (good[1:] != good[:-1])
        inner = edges[(edges > 0) & (edges < n)]
        new[inner] = True
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], n)
        starts, ends = starts[good[starts]], ends[good[starts]]
        most = size - piece + 1  # strings that hold one place of the key; a longer run repeats itself
        if len(starts) and (ends - starts).max() > most:
            parts = -(-(ends - starts) // most)
            first = np.repeat(starts, parts) + (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * most
            starts, ends = first, np.minimum(first + most, np.repeat(ends, parts))
        ctx = kernels.mix((c[ends + size - 1] - c[starts]) * q[starts] + (ends - starts).astype(U64))
        own = np.searchsorted(off, starts + at, "right") - 1
        out.append((m[starts], ctx, own, starts + at - off[own], ends - starts, eq[ends - 1] > eq[starts]))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, U64)] * 2 + [np.zeros(0, np.int64)] * 3 + [np.zeros(0, bool)]


CONTEXT = np.dtype([("key", "<u8"), ("ctx", "<u8"), ("doc", "<i8"), ("at", "<i8"), ("n", "<u2"), ("self", "?"), ("many", "?")])
REQUEST = np.dtype([("doc", "<i8"), ("key", "<u8"), ("at", "<i8"), ("n", "<u2"), ("hot", "?"), ("many", "?")])
SPAN = np.dtype([("doc", "<i8"), ("at", "<i8"), ("end", "<i8")])


def _pieces(a: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, list[bytes]]:
    """(group, the rows of a of that group as bytes), groups in order."""
    order = np.argsort(group, kind="stable")
    a, group = a[order], group[order]
    cuts = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.zeros(0, np.int64)
    ends = np.append(cuts[1:], len(group))[: len(cuts)]
    return group[cuts], [a[i:j].tobytes() for i, j in zip(cuts, ends, strict=True)]


def _columns(a: np.ndarray) -> bytes:
    """Rows of a as columns behind each other, which compress better."""
    return b"".join(np.ascontiguousarray(a[f]).tobytes() for f in a.dtype.names)


def _rows(data: bytes, dtype: np.dtype) -> np.ndarray:
    n = len(data) // dtype.itemsize
    out, at = np.empty(n, dtype), 0
    for f in dtype.names:
        w = dtype[f].itemsize
        out[f] = np.frombuffer(data, dtype[f], n, at)
        at += n * w
    return out


def _to_documents(a: np.ndarray, buckets: int) -> tuple[np.ndarray, list[bytes]]:
    """(bucket, rows) of rows with a document: few records, however many documents they are of."""
    return _pieces(a, (kernels.mix(a["doc"].astype(U64)) % U64(buckets)).astype(np.int64))


def _by_document(dtype: np.dtype):
    """One record with all rows of each document, from whole buckets."""

    def run(batches):
        got = [np.frombuffer(x.as_buffer(), dtype).copy() for batch in batches for x in batch.column("a")]
        if got:
            a = np.concatenate(got)
            got.clear()
            docs, blobs = _pieces(a, a["doc"])
            for k in range(0, len(docs), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(docs[k : k + 2000]), pa.array(blobs[k : k + 2000], pa.binary())], ["doc", "a"])

    return run


def _deal(docs: DataFrame, size: int, ranges: int, first: bool, buckets: int) -> DataFrame:
    """(range, kind, a): kind 0 has contexts by key range, kind 1 spans that are repeated within the batch, by document
    bucket. Of equal contexts of a batch the first one goes on alone, marked as one of many."""

    def run(part: pa.RecordBatch) -> pa.RecordBatch | None:
        buf, off = kernels.packed(part.column(1))
        key, ctx, own, at, n, selfish = contexts(buf, off, size)
        if not len(key):
            return None
        a = np.empty(len(key), CONTEXT)
        a["many"] = False
        a["key"], a["ctx"], a["doc"], a["at"], a["n"], a["self"] = key, ctx, part.column(0).to_numpy(zero_copy_only=False)[own], at, n, selfish
        # keys are minima and crowd at the low end: ranges are of mixed keys
        of = (kernels.mix(a["key"]) >> U64(32)) * U64(ranges) >> U64(32)
        order = np.lexsort((a["at"], a["doc"], a["ctx"], a["key"], of))
        a, of = a[order], of[order]
        new = np.concatenate([[True], (a["key"][1:] != a["key"][:-1]) | (a["ctx"][1:] != a["ctx"][:-1])])
        copies = np.bincount(np.cumsum(new) - 1)
        here = _spans(a[~new] if first else a[(copies > 1)[np.cumsum(new) - 1]], size)
        a = a[new]
        a["many"] = copies > 1
        cuts = np.searchsorted(of[new], np.arange(ranges + 1))
        full = np.flatnonzero(np.diff(cuts))
        to, blobs = _to_documents(here, buckets)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([full, to]).astype(np.int32)), pa.array([0] * len(full) + [1] * len(to), pa.int32()), pa.array([_columns(a[cuts[i] : cuts[i + 1]]) for i in full] + blobs, pa.binary())], ["range", "kind", "a"]
        )

    return common.arrow_map(docs, run, "range int, kind int, a binary", "text")


def _spans(contexts: np.ndarray, size: int) -> np.ndarray:
    """The bytes that the strings of contexts cover."""
    out = np.empty(len(contexts), SPAN)
    out["doc"], out["at"], out["end"] = contexts["doc"], contexts["at"], contexts["at"] + contexts["n"].astype(np.int64) + size - 1
    return out


def _meet(size: int, hot: int, first: bool, buckets: int):
    """Duplicate contexts as spans, and requests for the bytes of those that must be looked at."""

    def run(batches):
        got = []
        for batch in batches:
            kind = batch.column(1).to_numpy()
            passing = batch.take(np.flatnonzero(kind == 1))
            if passing.num_rows:
                yield pa.RecordBatch.from_arrays([passing.column(0).cast(pa.int64()), pa.array(np.zeros(passing.num_rows, np.int32)), passing.column(2)], ["bucket", "kind", "a"])
            got += [_rows(batch.column(2)[int(i)].as_buffer().to_pybytes(), CONTEXT) for i in np.flatnonzero(kind == 0)]
        if not got:
            return
        a = np.concatenate(got)
        got.clear()
        order = np.lexsort((a["at"], a["doc"], a["ctx"], a["key"]))
        a = a[order]
        new_key = np.concatenate([[True], a["key"][1:] != a["key"][:-1]])
        new = new_key | np.concatenate([[True], a["ctx"][1:] != a["ctx"][:-1]])
        kind = np.cumsum(new) - 1
        copies = np.bincount(kind) + np.bincount(kind, a["many"]).astype(np.int64)
        of_key = np.cumsum(new_key) - 1
        kinds = np.bincount(of_key[new])
        span = copies[kind] > 1 if not first else ~new
        spans = _spans(a[span], size)
        ask = new & ((kinds[of_key] > 1) | a["self"])
        requests = np.empty(int(ask.sum()), REQUEST)
        for f in ("doc", "key", "at", "n"):
            requests[f] = a[f][ask]
        requests["hot"], requests["many"] = kinds[of_key[ask]] > hot, copies[kind[ask]] > 1
        for rows, which in ((spans, 0), (requests, 1)):
            to, blobs = _to_documents(rows, buckets)
            yield pa.RecordBatch.from_arrays([pa.array(to), pa.array(np.full(len(to), which, np.int32)), pa.array(blobs, pa.binary())], ["bucket", "kind", "a"])

    return run


def _fetch(size: int, ranges: int, first: bool, buckets: int):
    """Contexts with their bytes by key; single strings of hot keys by hash range (n is -1), of equal ones of a batch the
    first; spans of the others (n is -2)."""

    def run(batches):
        for batch in batches:
            for part in common.by_bytes(batch, "text"):
                rows, hot = [], []
                ids = part.column(0).to_numpy(zero_copy_only=False)
                for k in range(part.num_rows):
                    data = part.column(1)[k].as_buffer().to_pybytes()
                    for _, key, at, n, is_hot, many in np.frombuffer(part.column(2)[k].as_buffer(), REQUEST).tolist():
                        if is_hot:
                            hot.append((k, at, n, many, data[at : at + n + size - 1]))
                        else:
                            rows.append((key - (1 << 64) if key >> 63 else key, int(ids[k]), at, n, many, data[at : at + n + size - 1]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()), strict=True)], FETCHED)
                if hot:
                    hs, ds, ps, ms = [], [], [], []
                    for k, at, n, many, data in hot:
                        b = np.frombuffer(data, np.uint8)
                        p, q = kernels.powers(len(b) + 1)
                        c = np.concatenate([[U64(0)], np.cumsum(kernels.TABLE[b] * p[: len(b)], dtype=U64)])
                        hs.append(kernels.mix((c[size : size + n] - c[:n]) * q[:n]))
                        ds.append(np.full(n, ids[k]))
                        ps.append(at + np.arange(n))
                        ms.append(np.full(n, many))
                    h = np.concatenate(hs)
                    a = np.empty(len(h), STRING)
                    a["hash"], a["doc"], a["at"], a["many"] = h, np.concatenate(ds), np.concatenate(ps), np.concatenate(ms)
                    a = a[np.lexsort((a["at"], a["doc"], a["hash"]))]
                    new = np.concatenate([[True], a["hash"][1:] != a["hash"][:-1]])
                    copies = np.bincount(np.cumsum(new) - 1)
                    here = a[~new] if first else a[(copies > 1)[np.cumsum(new) - 1]]
                    many = np.logical_or.reduceat(a["many"], np.flatnonzero(new)) | (copies > 1)
                    a = a[new]
                    a["many"] = many
                    spans = np.empty(len(here), SPAN)
                    spans["doc"], spans["at"], spans["end"] = here["doc"], here["at"], here["at"] + size
                    full, blobs = _pieces(a, ((a["hash"] >> U64(32)) * U64(ranges) >> U64(32)).astype(np.int64))
                    to, more = _to_documents(merged_each(spans), buckets)
                    n, zero = [*[-1] * len(full), *[-2] * len(to)], np.zeros(len(full) + len(to), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([full, to]).astype(np.int64)), pa.array(zero), pa.array(zero), pa.array(n, pa.int32()), pa.array(zero > 0), pa.array(blobs + more, pa.binary())], FETCHED)

    return run


STRING = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("at", "<i8"), ("many", "?")])
FETCHED = ["key", "doc", "at", "n", "many", "data"]


def suffix_ranks(text: np.ndarray, size: int) -> np.ndarray:
    """For each place of text, the rank of the string of `size` bytes there, by prefix doubling; the last places have none."""
    n = len(text)
    if size < 8:
        key = np.zeros(n - size + 1, np.int64)
        for i in range(size):
            key = key * 256 + text[i : i + len(key)]
        return np.unique(key, return_inverse=True)[1]
    key = np.zeros(n - 7, U64)
    for i in range(8):
        key = key << U64(8) | text[i : n - 7 + i].astype(U64)
    rank, have = np.unique(key, return_inverse=True)[1].astype(np.int64), 8
    while have < size:
        shift = min(have, size - have)
        pair = rank[:-shift] * (n + 1) + rank[shift:]
        rank, have = np.unique(pair, return_inverse=True)[1].astype(np.int64), have + shift
    return rank


def smaller_neighbours(position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Previous and next smaller values: for each place in an order, the nearest place before and behind whose value is
    smaller, or -1 and n."""
    n = len(position)
    out = []
    for turned in (False, True):
        v = position[::-1] if turned else position
        p = np.arange(-1, n - 1)
        open_ = np.flatnonzero((p >= 0) & (v[np.maximum(p, 0)] >= v)) if n else p
        while len(open_):  # a larger one's own smaller neighbour is the next candidate
            p[open_] = p[p[open_]]
            open_ = open_[(p[open_] >= 0) & (v[np.maximum(p[open_], 0)] >= v[open_])]
        out.append(n - 1 - p[::-1] if turned else p)
    return out[0], out[1]


def longest_previous_factor(rank: np.ndarray, position: np.ndarray, size: int) -> np.ndarray:
    """Of each string, the length (0 or size) up to which one of smaller position agrees with it.

    rank: suffix order up to `size` bytes, equal for equal strings; position: places, all different.
    """
    order = np.lexsort((position, rank))
    r, v = rank[order], position[order]
    before, behind = smaller_neighbours(v)
    n = len(r)
    reach = np.zeros(n, np.int64)
    for at, there in ((before, before >= 0), (behind, behind < n)):
        agree = np.zeros(n, bool)
        agree[there] = r[at[there]] == r[there]
        # between neighbours of equal rank every rank is equal, so the common prefix is `size`
        reach = np.maximum(reach, np.where(agree, size, 0))
    out = np.empty(n, np.int64)
    out[order] = reach
    return out


def repeated(data: list[bytes], many: np.ndarray, size: int, first: bool) -> list[np.ndarray]:
    """For each context (in order of document and place), which of its strings go."""
    text = np.frombuffer(b"".join(data), np.uint8)
    length = np.array([len(x) for x in data])
    begin = np.cumsum(length) - length
    n = length - size + 1
    at = np.repeat(begin, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    rank = suffix_ranks(text, size)[at]
    position = np.arange(len(at))
    gone = longest_previous_factor(rank, position, size) >= size
    if not first:
        gone |= longest_previous_factor(rank, -position, size) >= size
        gone |= np.repeat(many, n)
    return np.split(gone, np.cumsum(n)[:-1])


def _runs(gone: np.ndarray, at: int, size: int) -> list[tuple[int, int]]:
    d = np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))
    return [(at + i, at + j - 1 + size) for i, j in zip(np.flatnonzero(d == 1).tolist(), np.flatnonzero(d == -1).tolist(), strict=True)]


def _decide(size: int, first: bool, buckets: int):
    """Spans of the repeated strings; rows come sorted by key, with whole keys."""

    def judged(rows: list[tuple]) -> list[tuple[int, int, int]]:
        """Spans of some whole keys, by one suffix order of all their contexts; equal strings have one key."""
        rows.sort(key=lambda r: (r[1], r[2]))
        out = []
        for r, gone in zip(rows, repeated([r[5] for r in rows], np.array([r[4] for r in rows]), size, first), strict=True):
            if gone.any():
                out += [(r[1], i, j) for i, j in _runs(gone, r[2], size)]
        return out

    def batch(a: np.ndarray) -> pa.RecordBatch:
        to, blobs = _to_documents(a, buckets)
        return pa.RecordBatch.from_arrays([pa.array(to), pa.array(blobs, pa.binary())], ["bucket", "a"])

    def run(batches):
        rows, size_, strings, spans, found = [], 0, [], [], []
        for b in batches:
            key, doc, at, n, many = (b.column(i).to_pylist() for i in range(5))
            for k in range(b.num_rows):
                data = b.column(5)[k].as_buffer().to_pybytes()
                if n[k] == -1:
                    strings.append(np.frombuffer(data, STRING))
                    continue
                if n[k] == -2:
                    spans.append(np.frombuffer(data, SPAN))
                    continue
                if size_ > 2 << 20 and rows and rows[-1][0] != key[k]:
                    found += judged(rows)
                    rows, size_ = [], 0
                rows.append((key[k], doc[k], at[k], n[k], many[k], data))
                size_ += len(data)
        if rows:
            found += judged(rows)
        if found:
            yield batch(np.array(found, SPAN))
        if spans:
            yield batch(np.concatenate(spans))
        if strings:
            a = np.concatenate(strings)
            a = a[np.lexsort((a["at"], a["doc"], a["hash"]))]
            new = np.concatenate([[True], a["hash"][1:] != a["hash"][:-1]])
            if first:
                gone = ~new
            else:
                cnt = np.bincount(np.cumsum(new) - 1)
                gone = (cnt[np.cumsum(new) - 1] > 1) | a["many"]
            a = a[gone]
            s = np.empty(len(a), SPAN)
            s["doc"], s["at"], s["end"] = a["doc"], a["at"], a["at"] + size
            yield batch(merged_each(s))

    return run


def merged(spans: np.ndarray) -> np.ndarray:
    """Overlapping and touching spans as one."""
    if not len(spans):
        return spans
    spans = spans[np.argsort(spans["at"], kind="stable")]
    end = np.maximum.accumulate(spans["end"])
    new = np.concatenate([[True], spans["at"][1:] > end[:-1]])
    out = np.empty(int(new.sum()), SPAN)
    out["doc"], out["at"], out["end"] = spans["doc"][new], spans["at"][new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]
    return out


def merged_each(spans: np.ndarray) -> np.ndarray:
    """merged() within each document."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["at"], spans["doc"]))]
    new = np.concatenate([[True], (spans["doc"][1:] != spans["doc"][:-1]) | (spans["at"][1:] > spans["end"][:-1])])  # all of one length, so ends are in order
    out = spans[new]
    out["end"] = spans["end"][np.append(np.flatnonzero(new)[1:] - 1, len(spans) - 1)]
    return out


def dedup(docs: DataFrame, size: int = SIZE, keep: str = "first", hot: int = HOT, with_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and the kept text) of every row of docs (doc_id, text)."""
    first = keep == "first"
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(512, 8 * parts)
    rows = common.numbered(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    clean = rows.select("rid", "text")
    met = common.cut(_deal(clean, size, ranges, first, parts).repartition("range").mapInArrow(_meet(size, hot, first, parts), "bucket long, kind int, a binary"), "suffix-met")
    asked = met.where("kind = 1").select("bucket", "a").repartition("bucket").mapInArrow(_by_document(REQUEST), "doc long, a binary")
    fetched = clean.join(asked, clean.rid == asked.doc).select("rid", "text", "a").mapInArrow(_fetch(size, ranges, first, parts), "key long, doc long, at long, n int, many boolean, data binary")
    decided = fetched.repartition("key").sortWithinPartitions("key").mapInArrow(_decide(size, first, parts), "bucket long, a binary")
    spans = common.cut(met.where("kind = 0").select("bucket", "a").union(decided).repartition("bucket").mapInArrow(_by_document(SPAN), "doc long, a binary"), "suffix-spans")

    def cut_out(part: pa.RecordBatch) -> pa.RecordBatch:
        n, removed, count, sha, kept = [], [], [], [], []
        for k in range(part.num_rows):
            data = part.column(1)[k].as_buffer().to_pybytes()
            blob = part.column(2)[k].as_py()
            s = merged(np.frombuffer(blob, SPAN)) if blob else np.zeros(0, SPAN)
            left, at = [], 0
            for _, i, j in s.tolist():
                left.append(data[at:i])
                at = j
            left = b"".join([*left, data[at:]])
            n.append(len(data))
            removed.append(len(data) - len(left))
            count.append(len(s))
            sha.append(hashlib.sha256(left).hexdigest())
            kept.append(left.decode("utf-8", "replace") if with_text else None)
        out = [part.column(0), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(sha), pa.array(kept, pa.string())]
        return pa.RecordBatch.from_arrays(out[: 5 + with_text], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"][: 5 + with_text])

    rows = rows.join(spans, rows.rid == spans.doc, "left").select("doc_id", "text", "a")
    return common.arrow_map(rows, cut_out, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", text string" * with_text, "text")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.table(spark, sf_dir, "documents"), keep="none")
