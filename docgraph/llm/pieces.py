"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

At each position of the text the automaton's state and its output links name the pieces that end there. Each is
relaxed from the best path at the position where it starts:

* unigram models: the path with the largest sum of scores wins; a character without piece costs the least score
  less 10 and is spelled in bytes or becomes unknown.
* merge (BPE) models: sums of scores do not give such a model's segmentation. There a path is extended by a piece only
  if encoding the last two pieces together gives these two back; one path at most is left at each position, and it
  is the model's own segmentation. This needs, of each piece, which pieces stand at its ends while it is merged.

Spaces become U+2581 and one is put in front, as the model says. A text is cut wherever two characters meet that meet
in no piece; equal units of a worker are encoded once. The cache is bounded, so memory does not grow with the text or
the number of words.

Null and empty texts have no ids. A character that no piece has is spelled in bytes. Decoding gives the text back,
but for U+2581 itself, which comes back as a space; encode() decodes what it has made, and says for each text whether
that is the text. Very long texts are cut like others. Ties: of equal scores the path found first wins, which is the
library's. Repeated rows, and rows with a null doc_id, are encoded like others. An empty table gives no rows. Other
columns, of whatever name, are never read.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SPACE = "▁"
CACHE = 300_000
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    normal: list[bool]
    byte: list[int]  # the byte that a piece spells, or -1
    unknown: int
    merges: bool  # a BPE model
    prefix: bool = True
    ends: dict = field(default_factory=dict)  # piece -> what stands at its left and right end, and when


def _fields(data: bytes):
    """(number, value) of a protocol buffer message."""
    i = 0

    def varint():
        nonlocal i
        v = s = 0
        while True:
            b = data[i]
            i += 1
            v |= (b & 127) << s
            s += 7
            if b < 128:
                return v

    while i < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = {1: 8, 5: 4}.get(key & 7) or varint()
            yield key >> 3, data[i : i + n]
            i += n


def load(data: bytes) -> Vocabulary:
    """A vocabulary from the bytes of a model file."""
    v = Vocabulary([], [], [], [], 0, False)
    for number, value in _fields(data):
        if number == 1:
            piece, score, kind = "", 0.0, 1
            for n, x in _fields(value):
                if n == 1:
                    piece = x.decode()
                elif n == 2:
                    score = float(np.frombuffer(x, "<f4")[0])
                elif n == 3:
                    kind = x
            if kind == 2:
                v.unknown = len(v.pieces)
            v.pieces.append(piece)
            v.scores.append(score)
            v.normal.append(kind in (1, 4))
            v.byte.append(int(piece[3:5], 16) if kind == 6 else -1)
        elif number == 2:
            v.merges = dict(_fields(value)).get(3, 1) == 2
        elif number == 3:
            v.prefix = bool(dict(_fields(value)).get(3, 1))
    if v.merges:
        _find_ends(v)
    return v


def merged(chars: list[str], ids: dict[str, int], scores: list[float]) -> tuple[list[str], dict[str, tuple[str, str]]]:
    """Merging by best score, leftmost first: the pieces and, of each one made, its two parts."""
    n = len(chars)
    part, prev, nxt, made = list(chars), list(range(-1, n - 1)), [*range(1, n), -1], {}
    heap = []

    def offer(i, j):
        if i >= 0 and j >= 0 and (t := ids.get(part[i] + part[j])) is not None:
            heapq.heappush(heap, (-scores[t], i, j, part[i], part[j]))

    for i in range(n - 1):
        offer(i, i + 1)
    while heap:
        _, i, j, a, b = heapq.heappop(heap)
        if part[i] != a or part[j] != b or nxt[i] != j:
            continue
        made[a + b] = (a, b)
        part[i], part[j] = a + b, ""
        nxt[i] = nxt[j]
        if nxt[j] >= 0:
            prev[nxt[j]] = i
        offer(prev[i], i)
        offer(i, nxt[i])
    return [x for x in part if x], made


def _find_ends(v: Vocabulary) -> None:
    ids = {p: i for i, p in enumerate(v.pieces) if v.normal[i]}
    for p, t in ids.items():
        parts, made = merged(list(p), ids, v.scores)
        if parts != [p]:
            continue  # merging never makes this piece
        spines = []
        for side in (1, 0):
            spine, x, until = [], p, np.inf
            while True:
                born = -v.scores[ids[x]] if x in made else -np.inf
                spine.append((x, born, until))
                if x not in made:
                    break
                until, x = born, made[x][side]
            spines.append(spine)
        v.ends[t] = tuple(spines)  # right end, left end


class Encoder:
    def __init__(self, v: Vocabulary, cache: int = CACHE):
        self.v, self.most = v, cache
        self.ids = {p: i for i, p in enumerate(v.pieces) if v.normal[i]}
        self.bytes = {b: i for i, b in enumerate(v.byte) if b >= 0}
        self.automaton = ahocorasick.Automaton()
        for p, i in self.ids.items():
            if not v.merges or i in v.ends:
                self.automaton.add_word(p, (i, len(p)))
        self.automaton.make_automaton()
        chars = sorted({c for p in self.ids for c in p})
        self.kind = np.zeros(0x110000, np.uint16 if len(chars) < 65535 else np.uint32)
        self.kind[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.meet = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        inner = {x for p in self.ids for x in zip(p, p[1:], strict=False)}
        if inner:
            self.meet[tuple(np.array([[self.kind[ord(c)] for c in x] for x in inner]).T)] = True
        self.worst = min((s for s, n in zip(v.scores, v.normal, strict=True) if n), default=0.0) - 10
        # what each piece decodes to; control pieces to nothing
        spelled = [bytes([b]) if b >= 0 else p.replace(SPACE, " ").encode() if n else b"\xff" if i == v.unknown else b"" for i, (p, b, n) in enumerate(zip(v.pieces, v.byte, v.normal, strict=True))]
        self.raw = np.frombuffer(b"".join(spelled), np.uint8)
        self.raw_at = np.concatenate([[0], np.cumsum([len(x) for x in spelled])])
        self.sizes = [len(p) for p in v.pieces]
        self.chars = {p for p in self.ids if len(p) == 1}
        self.pairs: dict[int, bool] = {}
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.new: list[list[int]] = []  # made since the arrays below were
        self.flat, self.begin = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def settle(self) -> None:
        """Moves the new units' ids into the arrays: unit k has flat[begin[k] : begin[k + 1]]."""
        if self.new:
            self.flat = np.concatenate([self.flat, np.array([t for x in self.new for t in x], np.int32)])
            self.begin = np.concatenate([self.begin, self.begin[-1] + np.cumsum([len(x) for x in self.new])])
            self.new = []

    def joins(self, a: int, b: int) -> bool:
        """Whether pieces a and b, side by side, stay as they are."""
        key = a << 32 | b
        got = self.pairs.get(key)
        if got is None:
            got, ids, scores = True, self.ids, self.v.scores
            for x, born, until in self.v.ends[a][0]:
                for y, born2, until2 in self.v.ends[b][1]:
                    if (t := ids.get(x + y)) is not None:
                        at = max(-scores[t], born, born2)
                        # at a tie the left one is merged first
                        if at < until and at <= until2:
                            got = False
            if len(self.pairs) >= self.most * 4:
                self.pairs.clear()
            self.pairs[key] = got
        return got

    def walk(self, text: str) -> list[int] | None:
        """viterbi() of a merge model, for a text whose characters all have pieces; None if no path is left."""
        last: list[int | None] = [None] * (len(text) + 1)
        pairs, sizes = self.pairs, self.sizes
        for end, (t, k) in self.automaton.iter(text):
            end += 1
            if last[end] is None:
                if end != k:
                    p = last[end - k]
                    if p is None:
                        continue
                    fits = pairs.get(p << 32 | t)
                    if not (self.joins(p, t) if fits is None else fits):
                        continue
                last[end] = t
        out, n = [], len(text)
        while n:
            t = last[n]
            if t is None:
                return None
            out.append(t)
            n -= sizes[t]
        return out[::-1]

    def viterbi(self, text: str) -> list[int]:
        """Ids of a text in which spaces are U+2581 already; -1 - c stands for a character c without piece."""
        n, merges, scores = len(text), self.v.merges, self.v.scores
        if merges and self.ids.get(text, -1) in self.v.ends:
            return [self.ids[text]]
        last: list[int | None] = [None] * (n + 1)
        size, best = [0] * (n + 1), [0.0] + [-np.inf] * n
        last[0] = 0

        def blank(end):  # no piece ends here: the character stands alone
            start = end - 1
            if last[start] is not None and (text[start] not in self.ids):
                last[end], size[end], best[end] = -1 - ord(text[start]), 1, best[start] + self.worst

        done = 0
        for end, (t, k) in self.automaton.iter(text):
            end += 1
            while done < end - 1:  # positions without any match
                done += 1
                if last[done] is None:
                    blank(done)
            start = end - k
            p = last[start]
            if p is None:
                continue
            if merges:
                if last[end] is None and (start == 0 or p < 0 or self.joins(p, t)):
                    last[end], size[end] = t, k
            elif best[start] + scores[t] > best[end]:
                last[end], size[end], best[end] = t, k, best[start] + scores[t]
        while done < n:
            done += 1
            if last[done] is None:
                blank(done)
        if last[n] is None:  # a model whose pieces are not made by merging in order
            return [self.ids.get(x, -1 - ord(x[0])) for x in merged(list(text), self.ids, scores)[0]]
        out = []
        while n:
            out.append(last[n])
            n -= size[n]
        return out[::-1]

    def spelled(self, ids: list[int]) -> list[int]:
        """Characters without piece as bytes, or as unknown."""
        out = []
        for t in ids:
            if t >= 0:
                out.append(t)
            elif self.bytes:
                out += [self.bytes[b] for b in chr(-1 - t).encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.v.unknown:
                out.append(self.v.unknown)
        return out

    def unit(self, u: str) -> int:
        k = self.known.get(u)
        if k is None:
            k = self.known[u] = len(self.known)
            ids = self.walk(u) if self.v.merges and self.chars.issuperset(u) else None
            self.new.append(ids or self.spelled(self.viterbi(u)))
        return k

    def decoded(self, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of texts whose ids stand behind each other, n of each, and their offsets (one more than texts)."""
        begin, size = self.raw_at[ids], self.raw_at[ids + 1] - self.raw_at[ids]
        to = np.concatenate([[0], np.cumsum(size)])
        out = self.raw[np.arange(to[-1]) + np.repeat(begin - to[:-1], size)]
        off = to[np.concatenate([[0], np.cumsum(n)])]
        if self.v.prefix:  # the space that encoding puts in front
            first = off[:-1][np.diff(off) > 0]
            first = first[out[first] == 32]
            out = np.delete(out, first)
            off = off - np.searchsorted(first, off)
        return out, off

    def decode(self, ids: list[int]) -> str:
        return self.decoded(np.array(ids, np.int64), np.array([len(ids)]))[0].tobytes().decode("utf-8", "replace")

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, number of each, whether they decode to the text)."""
        if len(self.known) > self.most:
            self.clear()
        known, unit = self.known, self.unit
        own = [(SPACE if self.v.prefix else "") + t.replace(" ", SPACE) if t else "" for t in texts]
        whole = "".join(own)
        points = self.kind[np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)]
        cut = ~self.meet[points[:-1], points[1:]]
        ends = np.cumsum([len(t) for t in own])
        inside = ends[(ends > 0) & (ends < len(whole))]
        cut[inside - 1] = True
        marks = [0, *(np.flatnonzero(cut) + 1).tolist(), len(whole)] if whole else [0]
        units = [whole[i:j] for i, j in zip(marks, marks[1:], strict=False)]
        n = np.diff(np.searchsorted(marks, np.concatenate([[0], ends])))
        got = [known.get(u, -1) for u in units]
        at = np.array([unit(u) if k < 0 else k for k, u in zip(got, units, strict=True)], np.int64)
        self.settle()
        begin = self.begin[at]
        each = self.begin[at + 1] - begin
        to = np.concatenate([[0], np.cumsum(each)])
        ids = self.flat[np.arange(to[-1]) + np.repeat(begin - to[:-1], each)]
        cuts = np.concatenate([[0], np.cumsum(n)]).astype(np.int64)
        n = np.diff(to[cuts])
        out, off = self.decoded(ids, n)
        back = memoryview(np.ascontiguousarray(out))
        right = np.array([back[i:j] == (t or "").encode("utf-8", "surrogatepass") for i, j, t in zip(off.tolist(), off[1:].tolist(), texts, strict=False)], bool)
        return ids, n, right


def read_model(spark: SparkSession, path: str = MODEL) -> Vocabulary:
    """Reads a model file on the driver; local paths and those of Hadoop's file systems."""
    if "://" not in path:
        with open(path, "rb") as f:
            return load(f.read())
    return load(bytes(spark.read.format("binaryFile").load(path).select("content").first()[0]))


def encode(docs: DataFrame, vocabulary: Vocabulary, cache: int = CACHE) -> DataFrame:
    """doc_id, n_tokens, round_trip and ids of every row of docs (doc_id, text). cache: units that a worker keeps."""
    shipped = docs.sparkSession.sparkContext.broadcast(vocabulary)  # bounded by the model's vocabulary

    def run(batches):
        encoder = Encoder(shipped.value, cache)
        for batch in batches:
            for part in common.by_bytes(batch, "text", 2 << 20):
                ids, n, right = encoder.encode_batch(part.column(1).to_pylist())
                off = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n.astype(np.int64)), pa.array(right), pa.ListArray.from_arrays(pa.array(off), pa.array(ids))], ["doc_id", "n_tokens", "round_trip", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, round_trip boolean, ids array<int>")


def decode(rows: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """doc_id and text of every row of rows (doc_id, ids)."""
    shipped = rows.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        encoder = Encoder(shipped.value)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if x is None else encoder.decode(x) for x in batch.column(1).to_pylist()], pa.string())], ["doc_id", "text"])

    return rows.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(common.table(spark, sf_dir, "documents"), read_model(spark))
