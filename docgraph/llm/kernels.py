"""Vectorised text kernels shared by the operators: byte packing, word hashes, shingles.

A batch of texts is handled as one byte buffer with document offsets. Work goes over the buffer in
segments of SEGMENT bytes that are cut at white space, so memory is bounded by the segment and not by
the longest text. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SEGMENT = 1 << 18
U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)
_rng = np.random.Generator(np.random.PCG64(20240229))
TABLE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
LOWER = np.arange(256)
LOWER[65:91] += 32
TABLE_LOWER = TABLE[LOWER]
SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
#: For matching across punctuation: every ASCII character but letters and digits separates words.
SIGNS = np.zeros(256, bool)
SIGNS[:128] = [not chr(i).isalnum() for i in range(128)]
_COEF = [U64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3)]
_pow: list[np.ndarray] = [np.ones(1, U64), np.ones(1, U64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least n of each; kept for later calls up to 4 segments."""
    if len(_pow[0]) < n:
        made = []
        for base in (_BASE, _INV):
            p = np.full(max(n, SEGMENT + 4096), base, U64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        if n > 4 * SEGMENT:
            return made[0], made[1]
        _pow[:] = made
    return _pow[0], _pow[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A finaliser: spreads every bit of a sum or polynomial over the word."""
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(29)
    h *= U64(0xA0761D6478BD642F)
    h ^= h >> U64(32)
    return h


def packed(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes and the offsets (one more than rows) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    off = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    buf = np.frombuffer(raw, np.uint8)[off[0] : off[-1]] if raw is not None and len(raw) else np.zeros(0, np.uint8)
    return buf, off - off[0]


def words(buf: np.ndarray, off: np.ndarray, table: np.ndarray = TABLE_LOWER, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words [^\\x20\\x09-\\x0D]+ after lower-casing A-Z: (hashes, first byte, end byte, words per text)."""
    n = len(buf)
    if not n:
        return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(off) - 1, np.int64)
    inside = ~space[buf]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    first = np.unique(off[:-1][np.diff(off) > 0])
    starts[first] |= inside[first]
    last = np.unique(off[1:][np.diff(off) > 0]) - 1
    ends[last] |= inside[last]
    s = np.flatnonzero(starts)
    e = np.flatnonzero(ends) + 1
    del starts, ends, inside
    h = np.empty(len(s), U64)
    k = 0
    while k < len(s):
        base = s[k]
        j = max(k + 1, int(np.searchsorted(e, base + SEGMENT, "right")))
        top = e[j - 1]
        p, q = powers(int(top - base) + 1)
        c = np.zeros(top - base + 1, U64)
        np.cumsum(table[buf[base:top]] * p[: top - base], out=c[1:])
        h[k:j] = (c[e[k:j] - base] - c[s[k:j] - base]) * q[s[k:j] - base]
        k = j
    count = np.searchsorted(s, off[1:]) - np.searchsorted(s, off[:-1])
    return mix(h), s, e, count


def shingles(w: np.ndarray, count: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of runs of `size` words, in order, and their number per text; fewer words make one run."""
    at = np.concatenate([[0], np.cumsum(count)])
    run = np.zeros(max(0, len(w) - size + 1), U64)
    for i in range(size):
        run += w[i : i + len(run)] * _COEF[i % 5] + U64(i)
    run = mix(run)
    each = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    to = np.concatenate([[0], np.cumsum(each)])
    out = np.empty(int(to[-1]), U64)
    whole = np.ones(len(w), bool)
    # positions whose run would cross into the next text
    edge = at[1:][count > 0]
    for i in range(1, size):
        x = edge - i
        whole[x[x >= 0]] = False
    start = np.flatnonzero(whole[: len(run)]) if len(run) else np.zeros(0, np.int64)
    text = np.repeat(np.arange(len(count)), count)
    good = start[count[text[start]] >= size] if len(start) else start
    dst = to[text[good]] + good - at[text[good]]
    out[dst] = run[good]
    for d in np.flatnonzero((count > 0) & (count < size)):
        h = np.array([count[d] + 1000], U64)
        for i in range(at[d], at[d + 1]):
            h = mix(h * _COEF[0] + w[i : i + 1])
        out[to[d]] = h[0]
    return out, each


def sets(column: pa.Array, size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, in row order; empty for a text without words."""
    buf, off = packed(column)
    out: list[np.ndarray] = []
    k = 0
    while k < len(off) - 1:
        j = max(k + 1, int(np.searchsorted(off, off[k] + (1 << 21), "right")) - 1)
        w, _, _, count = words(buf[off[k] : off[j]], off[k : j + 1] - off[k])
        run, each = shingles(w, count, size)
        to = np.concatenate([[0], np.cumsum(each)])
        out += [np.unique(run[to[i] : to[i + 1]]) for i in range(j - k)]
        k = j
    return out
