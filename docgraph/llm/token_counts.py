"""Edit-aware token counts: a segment tree over each document's pre-tokens.

A byte-level merge vocabulary encodes each pre-token of its pattern alone, so a count is a sum over pre-tokens. The
tree's leaves are runs of LEAF pre-tokens with their characters and tokens; inner nodes hold sums. What is kept per
document is the leaves' sums. An edit is found by descending on the characters. Only the leaves that it touches are
encoded again, from a leaf that begins two characters before it or more (no pre-token that ends there looks as far as
the edit), up to the first old leaf boundary that is a pre-token boundary of the new text too; behind it nothing can
differ. Then the sums on the way to the root are set.

Edits are (start, end, replacement) in code points of the old text, in any order, not overlapping; an edit beyond the
text is cut to it, a null replacement is empty, overlapping ones are an error (ValueError). Null texts are empty and
count 0. Very long texts have a tree of more leaves. Repeated rows, and rows with a null doc_id, are counted each; ties
do not occur. An empty table gives no rows. Other columns, of whatever name, are never read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

LEAF, CACHE = 64, 400_000
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pre-token pattern of the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# What the query's edits clean up.
LONG_NUMBER, SIGN_RUN = r"[0-9]{4,}", r"[#$%&*!]{2,}"


class Counter:
    """Tokens of pre-tokens, kept for words seen; the cache is bounded."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(pattern)
        self.known: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        got = [known.get(p, 0) for p in pieces]
        if 0 in got:
            if len(known) > CACHE:
                known.clear()
            for k, p in enumerate(pieces):
                if not got[k]:
                    if p not in known:
                        known[p] = len(self.encoding._encode_single_piece(p.encode("utf-8", "replace")))
                    got[k] = known[p]
        return got


class Tree:
    """Sums of characters and tokens over the leaves, as a heap: node 1 is the root, leaves begin at `width`."""

    def __init__(self, chars: list[int], tokens: list[int]):
        self.n = len(chars)
        self.width = 1 << max(0, (self.n - 1).bit_length())
        pad = [0] * (self.width - self.n)
        self.chars, self.tokens = [0] * self.width + list(chars) + pad, [0] * self.width + list(tokens) + pad
        for sums in (self.chars, self.tokens):
            for k in range(self.width - 1, 0, -1):
                sums[k] = sums[2 * k] + sums[2 * k + 1]

    def find(self, at: int) -> tuple[int, int]:
        """(leaf that has character `at`, its first character); the last leaf for the end of the text."""
        k, begin = 1, 0
        while k < self.width:
            k *= 2
            if at >= begin + self.chars[k] and self.chars[k + 1]:
                begin += self.chars[k]
                k += 1
        return k - self.width, begin

    def set(self, leaf: int, chars: int, tokens: int) -> None:
        k = leaf + self.width
        self.chars[k], self.tokens[k] = chars, tokens
        while k > 1:
            k //= 2
            self.chars[k], self.tokens[k] = self.chars[2 * k] + self.chars[2 * k + 1], self.tokens[2 * k] + self.tokens[2 * k + 1]


def leaves(text: str, counter: Counter) -> tuple[list[int], list[int], int]:
    """(characters of each leaf, tokens of each leaf, pre-tokens) of a text."""
    pieces = counter.split(text)
    n = counter.counts(pieces)
    sizes = list(map(len, pieces))
    cuts = range(0, len(pieces), LEAF)
    return [sum(sizes[k : k + LEAF]) for k in cuts], [sum(n[k : k + LEAF]) for k in cuts], len(pieces)


def edited(text: str, chars: list[int], tokens: list[int], edits: list[tuple[int, int, str | None]], counter: Counter) -> tuple[str, Tree, int]:
    """(new text, tree of the new text, pre-tokens encoded again)."""
    tree, texts, at = Tree(chars or [0], tokens or [0]), [], 0
    for c in chars or [0]:
        texts.append(text[at : at + c])
        at += c
    edits = sorted((min(max(0, s), at), min(max(0, s, e), at), r or "") for s, e, r in edits)
    if any(a[1] > b[0] for a, b in zip(edits, edits[1:], strict=False)):
        raise ValueError("edits overlap")
    groups: list[list] = []  # first leaf, its first character, last leaf, edits
    for e in edits:
        a, begin = tree.find(max(0, e[0] - 2))
        b, _ = tree.find(e[1])
        if groups and a <= groups[-1][2]:
            groups[-1][2] = max(b, groups[-1][2])
            groups[-1][3].append(e)
        else:
            groups.append([a, begin, b, [e]])
    again = 0
    for a, begin, b, own in reversed(groups):
        old, parts, last = "".join(texts[a : b + 1]), [], 0
        for s, e, r in own:
            parts += [old[last : s - begin], r]
            last = e - begin
        new, more = "".join([*parts, old[last:]]), 1
        while True:
            ahead, k = "", b + 1
            while k < tree.n and len(ahead) < 256:
                ahead += texts[k]
                k += 1
            pieces, end = [], 0
            for m in counter.pattern.finditer(new + ahead):
                if end >= len(new):
                    break
                pieces.append(m.group())
                end = m.end()
            if end == len(new) or b + 1 >= tree.n:
                break
            # twice as many leaves each time, so that what is read again stays in proportion
            to = min(b + more, tree.n - 1)
            new += "".join(texts[b + 1 : to + 1])
            b, more = to, 2 * more
        again += len(pieces)
        texts[a] = new
        tree.set(a, len(new), sum(counter.counts(pieces)))
        for k in range(a + 1, b + 1):
            if texts[k]:
                texts[k] = ""
                tree.set(k, 0, 0)
    return "".join(texts), tree, again


def read_ranks(spark: SparkSession, path: str = VOCABULARY) -> dict[bytes, int]:
    """The vocabulary of a .tiktoken file, read on the driver."""
    if "://" in path:
        data = bytes(spark.read.format("binaryFile").load(path).select("content").first()[0])
    else:
        with open(path, "rb") as f:
            data = f.read()
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in data.splitlines() if x)}


def count(docs: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """doc_id, n_tokens, n_pieces and the leaves' sums of every row of docs (doc_id, text): the state for later edits."""
    shipped = docs.sparkSession.sparkContext.broadcast(ranks)  # bounded by the vocabulary

    def run(batches):
        counter = Counter(shipped.value)
        for batch in batches:
            for part in common.by_bytes(batch, "text"):
                got = [leaves(t or "", counter) for t in part.column(1).to_pylist()]
                ints = pa.list_(pa.int32())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([sum(t) for _, t, _ in got], pa.int64()), pa.array([n for _, _, n in got], pa.int64()), pa.array([c for c, _, _ in got], ints), pa.array([t for _, t, _ in got], ints)], ["doc_id", "n_tokens", "n_pieces", "leaf_chars", "leaf_tokens"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, n_pieces long, leaf_chars array<int>, leaf_tokens array<int>")


EDITED = "doc_id long, n_tokens long, n_edits long, n_tokens_edited long, n_pieces long, n_encoded_again long"


def recount(docs: DataFrame, ranks: dict[bytes, int], edits: Callable[[str], list[tuple[int, int, str | None]]] | None = None) -> DataFrame:
    """Counts before and after edits, of every row of docs.

    edits: makes the edits of a text; without it, docs has a column edits array<struct<start, end, replacement>>. Where
    docs has leaf_chars and leaf_tokens (of count()), they are used and only the edited leaves are encoded.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(ranks)
    has_state, has_edits = "leaf_chars" in docs.columns, edits is None

    def run(batches):
        counter = Counter(shipped.value)
        for batch in batches:
            for part in common.by_bytes(batch, "text"):
                rows = []
                for r in part.to_pylist():
                    text = r["text"] or ""
                    chars, tokens, n = (r["leaf_chars"] or [], r["leaf_tokens"] or [], None) if has_state else leaves(text, counter)
                    own = [(e["start"], e["end"], e["replacement"]) for e in r["edits"] or []] if has_edits else edits(text)
                    _, tree, again = edited(text, chars, tokens, own, counter) if own else (text, None, 0)
                    before = sum(tokens)
                    rows.append((r["doc_id"], before, len(own), tree.tokens[1] if tree else before, n, again))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], ["doc_id", "n_tokens", "n_edits", "n_tokens_edited", "n_pieces", "n_encoded_again"])

    keep = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *(["leaf_chars", "leaf_tokens"] if has_state else []), *(["edits"] if has_edits else [])]
    return docs.select(*keep).mapInArrow(run, EDITED)


def cleaning(text: str) -> list[tuple[int, int, str]]:
    """Edits that put 0 for long numbers and drop runs of signs."""
    return [(m.start(), m.end(), "0" if m.group()[0].isdigit() else "") for m in _CLEAN.finditer(text)]


_CLEAN = re.compile(f"{LONG_NUMBER}|{SIGN_RUN}")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return recount(common.table(spark, sf_dir, "documents"), read_ranks(spark), cleaning)
