"""Toxicity by a weighted finite-state pattern grammar.

Five lexical transducers (insult, threat, target, negation, reported speech) turn tokens into symbols; each passes on what it
does not know. They are composed, and the result is composed with transducers over symbols that look at order and scope:

    negation    an insult or threat within SCOPE tokens behind a negation is a negated one
    reporting   an insult or threat behind a verb of saying, to the end of the clause, is a reported one
    target      an insult or threat within SCOPE tokens behind a target is aimed at it
    clause      the strongest insult and threat of a clause; one that a target follows within SCOPE tokens is aimed at it,
                one that a verb of saying follows is reported; at the end of the clause its labels are emitted

The five lexical transducers are kept as one table of tokens, which is what they compose to. Its insults weigh the log-odds of
the words (a threat has 1). The arcs that close a clause carry the learned weights of its labels, but the score does not read
them there: it is a logistic function of a document's labels, each counted by the logarithm of the lexical weights of its clauses,
with these learned weights. So matched clauses count and isolated words do not.

Insults are learned: words, and stems that take many endings, which stand in labelled toxic rows so much more often than in
clean ones that no chance explains it, however few the rows (choose()). The rows to learn from are at most `sample` labelled
rows, those of the smallest hash of doc_id; all of them if there are fewer. Near copies among them (rows that share one of
BANDS bands of WIDTH min-hashes of three-word shingles, or are linked by others that do) weigh as much as one row
together, so that no group of copies teaches its own words. Both the lexicon and the weights come from them. Without labelled rows of both kinds the lexicon is empty and every score is the share of toxic labels (0 without any).

Null and empty texts have no clause and get the score of a document without matches. Very long texts are walked once; clauses
without insult or threat are skipped. Rows with a null doc_id are scored but never learned from. Repeated rows, and ties of
any kind, are scored alike. An empty table gives no rows. Other columns, of whatever name, are never read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, kernels

SAMPLE = 20_000
THRESHOLD = 0.3
# Closed-class vocabulary of the grammar.
THREATS = {"kill", "hurt", "destroy", "beat", "shoot", "stab", "burn", "töten", "schlagen", "tuer", "frapper", "matar", "golpear"}
TARGETS = {"you", "your", "he", "she", "they", "him", "her", "them", "this", "that", "these", "those", "du", "sie", "er", "ihr", "tu", "vous", "il", "elle", "ils", "usted", "tú", "él", "ella", "ellos"}
NEGATIONS = {"not", "never", "no", "isn't", "aren't", "wasn't", "nicht", "kein", "keine", "nie", "ne", "pas", "jamais", "nunca", "tampoco"}
REPORTS = {"said", "says", "quoted", "quote", "wrote", "reported", "called", "sagte", "schrieb", "dit", "écrit", "dijo", "escribió"}
#: Labels of clauses, and what a label weighs before any row is seen.
LABELS = {"insult": 1.0, "insult_target": 1.5, "insult_negated": 0.0, "insult_reported": 0.0, "threat": 0.0, "threat_target": 1.0, "threat_negated": 0.0, "threat_reported": 0.0}
CLAUSE_END = re.compile(r"[.!?;\n]")
TOKEN = re.compile(r"[^\W_]+(?:'[^\W_]+)?")
STEMS, SCOPE, BANDS, WIDTH = (4, 5, 6, 7), 4, 12, 5
#: How much more frequent an insult is in toxic rows than in clean ones, at least.
RATIO = 8.0
#: Symbols: insult I, threat H, target T, negation N, report R, the end of a clause ".", any other token "-"; a letter behind
#: I or H says how it was met.
PLAIN = ["I", "H", "T", "N", "R", ".", "-"]
HOW = {"n": "negated", "r": "reported", "t": "target", "": ""}
SYMBOLS = [*PLAIN, *(c + h for c in "IH" for h in "nrt")]

Arcs = dict[tuple, tuple]


class Transducer:
    """Arcs (state, symbol) -> (state, output, weight) over SYMBOLS."""

    def __init__(self, start, arcs: Arcs):
        self.start, self.arcs = start, arcs


def transducer(start, step) -> Transducer:
    """All arcs that step(state, symbol) has from the start on."""
    arcs, open_ = {}, [start]
    seen = {start}
    while open_:
        state = open_.pop()
        for symbol in SYMBOLS:
            arcs[state, symbol] = to, _, _ = step(state, symbol)
            if to not in seen:
                seen.add(to)
                open_.append(to)
    return Transducer(start, arcs)


def composed(first: Transducer, second: Transducer) -> Transducer:
    """The transducer whose second part reads what the first one writes; weights add up."""

    def step(state, symbol):
        p, out, x = first.arcs[state[0], symbol]
        q, out, y = second.arcs[state[1], out]
        return (p, q), out, x + y

    return transducer((first.start, second.start), step)


def negation(scope: int = SCOPE) -> Transducer:
    def step(left, symbol):
        if symbol == ".":
            return 0, symbol, 0.0
        out = symbol + "n" if symbol in ("I", "H") and left else symbol
        return scope if symbol == "N" else max(0, left - 1), out, 0.0

    return transducer(0, step)


def reporting() -> Transducer:
    def step(said, symbol):
        out = symbol + "r" if symbol in ("I", "H") and said else symbol
        return symbol == "R" or said and symbol != ".", out, 0.0

    return transducer(False, step)


def target(scope: int = SCOPE) -> Transducer:
    def step(left, symbol):
        if symbol == ".":
            return 0, symbol, 0.0
        out = symbol + "t" if symbol in ("I", "H") and left else symbol
        return scope if symbol == "T" else max(0, left - 1), out, 0.0

    return transducer(0, step)


def clause(weights: dict[str, float], scope: int = SCOPE) -> Transducer:
    """States (insult, threat, tokens for which a target may follow): how each was met, None if it was not. Writes labels."""
    order = [None, "n", "r", "", "t"]

    def step(state, symbol):
        insult, threat, left = state
        if symbol == ".":
            out = tuple(name + ("_" + HOW[h] if h else "") for name, h in (("insult", insult), ("threat", threat)) if h is not None)
            return (None, None, 0), out, sum(weights[x] for x in out)
        left = max(0, left - 1)
        if symbol[0] in "IH":
            how = symbol[1:]
            if symbol[0] == "I":
                insult = max(insult, how, key=order.index)
            else:
                threat = max(threat, how, key=order.index)
            left = scope
        elif symbol == "T" and left:
            insult, threat = ("t" if h == "" else h for h in (insult, threat))
        elif symbol == "R":
            insult, threat = ("r" if h in ("", "t") else h for h in (insult, threat))
        return (insult, threat, left), (), 0.0

    return transducer((None, None, 0), step)


class Lexicon:
    """The composition of the five lexical transducers: token -> (symbol, weight)."""

    def __init__(self, words: dict[str, float], stems: dict[str, float]):
        self.words, self.stems = words, stems
        self.known = {w: (c, float(c == "H")) for c, ws in (("H", THREATS), ("R", REPORTS), ("N", NEGATIONS), ("T", TARGETS)) for w in ws} | {w: ("I", x) for w, x in words.items()}

    def read(self, token: str) -> tuple[str, float]:
        if (got := self.known.get(token)) is None:
            for n in STEMS:
                if (x := self.stems.get(token[:n])) is not None and len(token) >= n:
                    return "I", x
            return "-", 0.0
        return got


class Scorer:
    """The composed grammar, walked only over clauses with a trigger."""

    def __init__(self, words: dict[str, float], stems: dict[str, float], weights: list[float] | None = None):
        self.parts, self.weights, self.lexicon = (words, stems), weights, Lexicon(words, stems)
        grammar = composed(composed(composed(negation(), reporting()), target()), clause(dict(zip(LABELS, weights[1:] if weights else [0.0] * len(LABELS), strict=True))))
        names = {s: k for k, s in enumerate({grammar.start: 0} | {s: 0 for s, _ in grammar.arcs})}
        self.arcs = {(names[s], x): (names[to], out, w) for (s, x), (to, out, w) in grammar.arcs.items() if x in PLAIN}
        self.triggers = ahocorasick.Automaton()
        for w in (*words, *stems, *THREATS):
            self.triggers.add_word(w, len(w))
        if len(self.triggers):
            self.triggers.make_automaton()

    def features(self, text: str | None) -> list[float]:
        """log(1 + weights of the clauses) for each label."""
        out = dict.fromkeys(LABELS, 0.0)
        if text and len(self.triggers):
            low, done = text.lower(), 0
            for end, n in self.triggers.iter(low):
                at = end - n + 1
                if at < done or at and (low[at - 1].isalnum() or low[at - 1] == "_"):
                    continue
                begin = max(low.rfind(c, done, at) for c in ".!?;\n") + 1 or done
                stop = CLAUSE_END.search(low, at)
                done = stop.end() if stop else len(low)
                state, weight = 0, 0.0
                for token in TOKEN.finditer(low, begin, done):
                    symbol, w = self.lexicon.read(token.group())
                    state = self.arcs[state, symbol][0]
                    weight += w
                for label in self.arcs[state, "."][1]:
                    out[label] += weight
        return [math.log1p(out[x]) for x in LABELS]

    def score(self, text: str | None) -> float:
        x = self.weights[0] + sum(w * v for w, v in zip(self.weights[1:], self.features(text), strict=True))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def stands_out(a: float, b: float, share: float, features: int) -> bool:
    """Whether a of a + b rows being toxic is less likely than once in all features by chance (Chernoff's bound)."""
    p = a / (a + b)
    gain = p * math.log(p / share) + ((1 - p) * math.log((1 - p) / (1 - share)) if p < 1 else 0.0)
    return p > share and (a + b) * gain >= math.log(features)


def choose(counts: list[tuple[str, float, float]], n1: float, n0: float, features: int, ratio: float = RATIO) -> tuple[dict[str, float], dict[str, float]]:
    """Words and stems (marked by a final '*') that stand out in toxic rows, with log-odds between 0.5 and 3.

    They must be `ratio` times as frequent there as in clean rows, and not by chance among as many features as there are.
    """
    good = {f: (a, b) for f, a, b in counts if a / n1 >= ratio * b / n0 and stands_out(a, b, n1 / (n1 + n0), features)}
    odds = lambda a, b: min(3.0, max(0.5, math.log10((a + 0.5) / n1 * n0 / (b + 0.5))))
    lexicon, stems = {}, {}
    words = {f: x for f, x in good.items() if f[-1] != "*"}
    for f, (a, b) in sorted(((f, x) for f, x in good.items() if f[-1] == "*"), key=lambda y: (len(y[0]), y[0])):
        stem = f[:-1]
        if not any(stem[:n] in stems for n in STEMS) and a > 1.1 * max([0, *(x[0] for w, x in words.items() if w.startswith(stem))]):
            stems[stem] = odds(a, b)
    for w, (a, b) in words.items():
        if not any(w[:n] in stems for n in STEMS):
            lexicon[w] = odds(a, b)
    return lexicon, stems


def fit_weights(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[float]:
    """Ridge logistic regression of weighted rows towards the weights of LABELS by Newton steps; the intercept comes first."""
    x = np.column_stack([np.ones(len(x)), x])
    before = np.array([0.0, *LABELS.values()])
    w, ridge = before.copy(), np.eye(x.shape[1]) * 0.1
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (weight * p * (1 - p))[:, None]) + ridge, x.T @ (weight * (y - p)) - ridge @ (w - before))
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w.tolist()


def bands(text: str) -> list[int]:
    """BANDS hashes of WIDTH min-hashes each of the text's three-word shingles; none without words."""
    w, _, _, count = kernels.words(*kernels.packed(pa.array([text])))
    run, _ = kernels.shingles(w, count, 3)
    if not len(run):
        return []
    each = (np.arange(BANDS * WIDTH, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]
    least = np.min([kernels.mix(run[k : k + 4096] + each).min(axis=1) for k in range(0, len(run), 4096)], axis=0).reshape(BANDS, WIDTH)
    own = np.arange(BANDS, dtype=np.uint64)
    for c in least.T:
        own = kernels.mix(own * np.uint64(0xD6E8FEB86659FD93) + c)
    return own.view(np.int64).tolist()


def _signed(batch: pa.RecordBatch) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array([bands(t or "") for t in batch.column(0).to_pylist()], pa.list_(pa.int64()))], ["text", "toxic", "bands"])


def _weighted(rows: DataFrame) -> DataFrame:
    """text, toxic and weight of rows (text, toxic): one over the size of the row's group of near copies."""
    signed = common.arrow_map(rows, _signed, "text string, toxic int, bands array<bigint>", "text")
    rows = common.cut(signed.withColumn("rid", F.monotonically_increasing_id()), "toxic-sample")
    each = rows.select("rid", F.explode("bands").alias("band"))
    heads = each.groupBy("band").agg(F.min("rid").alias("head"))
    edges = common.join_hot(each, heads, ["band"], "rid").where("rid <> head").select("rid", "head")
    group = common.components(edges, "rid", "head", "toxic-copies").withColumnRenamed("node", "rid")
    own = rows.select("rid", "text", "toxic").join(group, "rid", "left").withColumn("of", F.coalesce("component", "rid"))
    return common.cut(common.join_hot(own, own.groupBy("of").agg((1 / F.count("*")).alias("weight")), ["of"], "rid").select("text", "toxic", "weight"), "toxic-weighted")


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Scorer:
    """A scorer from labelled rows of docs (doc_id, text); labels: (doc_id, toxic). At most `sample` rows are read."""
    ids = labels.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(ids), "doc_id").select("text", "toxic")
    rows = _weighted(rows)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[float]] = {"": [0.0, 0.0]}
        for batch in batches:
            for text, toxic, weight in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                tokens = set(TOKEN.findall((text or "").lower()))
                tokens |= {t[:n] + "*" for t in tokens for n in STEMS if len(t) > n}
                for t in ("", *tokens):
                    found.setdefault(t, [0.0, 0.0])[toxic] += weight
        yield pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array([x[1] for x in found.values()]), pa.array([x[0] for x in found.values()])], ["f", "a", "b"])

    # sums are rounded, so that their order has no effect
    total = lambda c: F.round(F.sum(c), 6).alias(c)
    counts = common.cut(rows.mapInArrow(count, "f string, a double, b double").groupBy("f").agg(total("a"), total("b")), "toxic-counts")
    n1, n0 = next(((r.a, r.b) for r in counts.where("f = ''").collect()), (0, 0))
    if not n1 or not n0:
        share = n1 / max(1, n1 + n0)
        return Scorer({}, {}, [math.log((share + 1e-6) / (1 - share + 1e-6)), *[0.0] * len(LABELS)])
    features = counts.where("a + b >= 3").count()
    # what can pass choose(); bounded by the words of the sample
    top = counts.where((F.col("f") != "") & (F.col("a") + F.col("b") >= 3) & (F.col("a") * n0 >= RATIO * F.col("b") * n1)).collect()
    lexicon = choose([(r.f, r.a, r.b) for r in top], n1, n0, max(2, features))

    def features_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        s = Scorer(*lexicon)
        x = [s.features(t) for t in batch.column(0).to_pylist()]
        return pa.RecordBatch.from_arrays([pa.array(x, pa.list_(pa.float64())), *batch.columns[1:]], ["x", "toxic", "weight"])

    got = common.arrow_map(rows, features_of, "x array<double>, toxic int, weight double", "text").groupBy("x", "toxic").agg(total("weight")).orderBy("x", "toxic").collect()
    return Scorer(*lexicon, fit_weights(np.array([r.x for r in got]), np.array([r.toxic for r in got], float), np.array([r.weight for r in got])))


def score(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from the threshold on) of every row of docs."""
    parts, weights = scorer.parts, scorer.weights

    def run(batches):
        s = Scorer(*parts, weights)
        for batch in batches:
            for part in common.by_bytes(batch, "text"):
                v = np.array([s.score(t) for t in part.column(1).to_pylist()])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(v), pa.array((v >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, score double, predicted int")


def clean(docs: DataFrame, scorer: Scorer, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, that score below the threshold."""
    parts, weights, at = scorer.parts, scorer.weights, docs.columns.index("text")

    def run(batches):
        s = Scorer(*parts, weights)
        for batch in batches:
            for part in common.by_bytes(batch, "text"):
                yield part.filter(pa.array([s.score(t) < threshold for t in part.column(at).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels")
    scorer = learn(docs.where(~common.held_out()), labels.where(~common.held_out()))
    return score(docs, scorer).withColumn("held_out", F.coalesce(common.held_out(), F.lit(False))).select("doc_id", "held_out", "score", "predicted")
