"""Language identification by hierarchical discrimination.

Languages are first put into families, by the similarity of their mean feature vectors. A text's family comes
from the nearest family model (multinomial, over hashed character n-grams); one-versus-one linear support vector
machines within the family then vote for the language. Features are the relative frequencies of hashed runs of
one to three characters of lower-cased letters and of word ends, over the whole text.

Models are learned from at most `sample` rows of known language, those of the smallest hash of doc_id. The score
is a logistic function of the smallest margin that the winner has over another language, of the family models for
languages of other families. Text that is null or has no letter gives `und` and 0. With one learned language that
one is given with score 1 to every text with a letter; with none, `und`. Ties go to the first name in order.
Repeated rows get the same answer; of rows that share a doc_id one is learned from, its text with its own label. Rows with a null doc_id are
answered, not learned from. Very long texts are read whole, in pieces. An empty table gives no rows, and no languages
to learn. Other columns, of whatever name, are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

SAMPLE, BINS, EPOCHS = 4_000, 1 << 11, 12


def _folded(text: str) -> np.ndarray:
    """Code points of the lower-cased text, every run of other characters than letters as one space."""
    a = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    table = _letters()
    is_letter = table[np.minimum(a, len(table) - 1)]
    a = np.where(is_letter, a, 32)
    keep = np.ones(len(a), bool)
    keep[1:] = is_letter[1:] | is_letter[:-1]
    return a[keep]


_table: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _table:
        _table.append(np.array([chr(i).isalpha() if not 0xD800 <= i < 0xE000 else False for i in range(0x110000)]))
    return _table[0]


def counts(text: str | None) -> np.ndarray | None:
    """How often each bin of character 1- to 3-grams occurs; None without a letter. Long texts go in pieces."""
    if not text:
        return None
    out, seen = np.zeros(BINS), False
    for k in range(0, len(text), 1 << 19):
        a = _folded(text[k : k + (1 << 19) + 2]).astype(np.uint64)
        if not (a != 32).any():
            continue
        seen = True
        h = a * np.uint64(0x9E3779B97F4A7C15)
        for g in range(3):
            if g:
                h = (h[:-1] ^ (h[:-1] >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93) + a[g:] * np.uint64(0x9E3779B97F4A7C15)
            out += np.bincount((h >> np.uint64(40)).astype(np.int64) & (BINS - 1), minlength=BINS)
    return out if seen else None


def vector(c: np.ndarray) -> np.ndarray:
    v = np.sqrt(c)
    return v / np.sqrt((v * v).sum())


@dataclass
class Model:
    languages: list[str]
    families: list[list[int]]
    family_log: np.ndarray  # families x bins, log-probabilities
    machines: dict[tuple[int, int], np.ndarray]  # (i, j), i < j, of one family: weights and bias; positive for i
    scale: float

    def predict(self, c: np.ndarray | None) -> tuple[str, float]:
        if c is None or not self.languages:
            return "und", 0.0
        if len(self.languages) == 1:
            return self.languages[0], 1.0
        of = self.family_log @ (c / c.sum())
        f = int(np.argmax(of))
        rest = np.delete(of, f)
        margin = (of[f] - rest.max()) * 40 if len(rest) else np.inf
        v, own = vector(c), self.families[f]
        votes, sums = dict.fromkeys(own, 0), dict.fromkeys(own, np.inf)
        for (i, j), w in self.machines.items():
            if i in votes and j in votes:
                m = float(v @ w[:-1] + w[-1])
                votes[i if m >= 0 else j] += 1
                sums[i], sums[j] = min(sums[i], m), min(sums[j], -m)
        best = max(own, key=lambda i: (votes[i], sums[i], -i))
        least = min(margin, sums[best] * self.scale)
        return self.languages[best], float(1 / (1 + np.exp(-np.clip(least, -30, 30))))


def fit(vectors: np.ndarray, raw: np.ndarray, names: list[str]) -> Model:
    """vectors, raw: features and counts of the rows; names: their languages.

    Languages of one family are closer to each other, as centred mean features go, than languages are on average.
    """
    languages = sorted(set(names))
    y = np.array([languages.index(x) for x in names])
    if len(languages) < 2:
        return Model(languages, [[i] for i in range(len(languages))], np.zeros((len(languages), BINS)), {}, 1.0)
    means = np.array([vectors[y == i].mean(0) for i in range(len(languages))])
    centred = means - means.mean(0)
    centred /= np.maximum(np.linalg.norm(centred, axis=1), 1e-12)[:, None]
    close = centred @ centred.T
    family = (close.sum() - len(languages)) / (len(languages) * (len(languages) - 1))
    parent = list(range(len(languages)))
    pairs = sorted(((close[i, j], -i, -j) for i in range(len(languages)) for j in range(i + 1, len(languages))), reverse=True)
    groups = {i: [i] for i in parent}
    for s, i, j in pairs:  # complete linkage: every pair of a family is close
        a, b = parent[-i], parent[-j]
        if a != b and s >= family and all(close[x, z] >= family for x in groups[a] for z in groups[b]):
            for x in groups.pop(b):
                parent[x] = a
                groups[a].append(x)
    families = [sorted(g) for _, g in sorted(groups.items())]
    if len(families) == len(languages) > 2:  # nothing is close: the two closest make a family
        i, j = -pairs[0][1], -pairs[0][2]
        families = [sorted((i, j)), *([x] for x in range(len(languages)) if x not in (i, j))]
    total = np.array([sum((raw[y == i] / raw[y == i].sum(1)[:, None]).mean(0) for i in g) / len(g) for g in families])
    log = np.log(total + 1e-6)
    machines = {}
    for g in families:
        for a, i in enumerate(g):
            for j in g[a + 1 :]:
                rows = (y == i) | (y == j)
                machines[i, j] = svm(vectors[rows], np.where(y[rows] == i, 1.0, -1.0))
    return Model(languages, families, log, machines, 3.0)


def svm(x: np.ndarray, y: np.ndarray, c: float = 10.0, epochs: int = EPOCHS) -> np.ndarray:
    """Linear support vector machine with squared hinge loss by dual coordinate descent; the bias comes last."""
    x = np.column_stack([x, np.full(len(x), 0.5)])
    w, alpha, q = np.zeros(x.shape[1]), np.zeros(len(x)), (x * x).sum(1) + 0.5 / c
    weight = np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    rng = np.random.Generator(np.random.PCG64(7))
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            g = y[i] * (x[i] @ w) - 1 + alpha[i] * 0.5 / (c * weight[i])
            new = max(0.0, alpha[i] - g / q[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    w[-1] *= 0.5
    return w


def learn(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from at most `sample` rows of docs (doc_id, text, lang) whose lang is not null."""
    one = docs.where("lang is not null and doc_id is not null").select("doc_id", "lang", F.xxhash64("text").alias("h"))
    ids = one.groupBy("doc_id").agg(F.min(F.struct("h", "lang")).alias("one")).select("doc_id", F.col("one.lang").alias("known"), F.col("one.h").alias("h")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("h")).join(F.broadcast(ids), ["doc_id", "h"]).select(F.col("doc_id").cast("string").alias("doc_id"), "text", "known")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        got = [(d, c.astype(np.float32).tobytes(), k) for d, t, k in zip(*(x.to_pylist() for x in batch.columns), strict=True) if (c := counts(t)) is not None]
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in got], t) for i, t in enumerate((pa.string(), pa.binary(), pa.string()))], ["doc_id", "c", "known"])

    # a row that stands many times counts once, so no more than `sample` vectors come to the driver
    made = common.arrow_map(rows, run, "doc_id string, c binary, known string", "text").groupBy("doc_id").agg(F.min("c").alias("c"), F.min("known").alias("known"))
    got = sorted((r.known, bytes(r.c)) for r in made.collect())
    raw = np.frombuffer(b"".join(c for _, c in got), np.float32).reshape(len(got), BINS)
    vectors = np.sqrt(raw)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-12)[:, None]
    return fit(vectors, raw, [k for k, _ in got])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every row of docs (doc_id, text)."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        got = [model.predict(counts(t)) for t in batch.column(1).to_pylist()]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return common.arrow_map(rows, run, "doc_id long, lang_pred string, score double", "text")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    found = identify(docs, learn(docs.where(~common.held_out())))
    return found.select("doc_id", F.coalesce(common.held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
