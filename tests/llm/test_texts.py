"""Spelling variants, substring dedup and fill-in-the-middle against brute force, and their queries against SQL."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from docgraph.llm import fill_middle, kernels, queries, spelling, substring_dedup

from .test_operators import BASE, TEXTS, empty, hostile

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
R = random.Random(5)


@pytest.mark.parametrize("name", ["op11_spelling", "op12_substring_dedup", "op13_fill_in_middle"])
def test_query_equals_sql(spark, data, name):
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{os.path.join(data, 'documents.parquet')}'")
    result = db.execute(queries.oracle_sql()[name])
    names = [x[0] for x in result.description]
    df = queries.queries()[name](spark, data)
    assert sorted(df.columns) == sorted(names)
    got = [tuple(r[c] for c in names) for r in df.collect()]
    assert got and sorted(map(repr, got)) == sorted(map(repr, result.fetchall()))


# spelling


def low(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def drawn(doc_id, w):
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{w}".encode())
    return w[: h % len(w)] + w[h % len(w) + 1 :] if h % 31 == 0 else w


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def variants(rows, draw):
    n = Counter()
    for d, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            n[drawn(d, low(w)) if draw else low(w)] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}
    near = {w: [x for x in n if one_edit(w, x)] for w in n}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return sorted(out, key=repr)


def spelled():
    """Words in chains of misspellings, with doubled letters, accents, ties and a length above LONG."""
    long = "q" * 30 + "r" * 30
    many = [("straight", 900), ("straigth", 3), ("strraight", 60), ("strraightt", 4), ("straighx", 5), ("straighy", 5), ("élégance", 20), ("elégance", 2), ("bookkeeper", 40), ("bokkeeper", 4), ("bookeeper", 3), (long, 30), (long[:-1], 2), (long[:10] + "x" + long[11:], 3), ("shorty", 50), ("shortys", 5), ("xxxxxxxx", 20), ("xxxxxxx", 2), ("xxxxxxxxx", 2)]
    words = [w.upper() if R.random() < 0.2 and w.isascii() else w for w, k in many for _ in range(k)]
    R.shuffle(words)
    return [(i, "-".join(words[k : k + 40]) + " 7×") for i, k in enumerate(range(0, len(words), 40))]


def test_spelling(spark):
    rows = spelled()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for draw in (False, True):
        got = [(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(spelling.vocabulary(df, drawn=draw)).collect()]
        assert sorted(got, key=repr) == variants(rows, draw)
        assert any(r[1] and r[1] != r[2] for r in got)  # a chain


def test_spelling_hostile(spark):
    df, rows = hostile(spark)
    rows = [*rows, (None, "no id " + BASE)]
    words = spelling.vocabulary(df, drawn=True)
    assert sorted([tuple(r) for r in spelling.variants(words).select("word", "form", "root", "n", "n_near", "form_n").collect()], key=repr) == variants(rows, True)
    assert spelling.variants(spelling.vocabulary(empty(spark), drawn=True)).count() == 0
    assert spelling.variants(words.where("n < 0")).count() == 0


# substring dedup


def without_copies(rows, size):
    words = [SPACED.findall(t or "") for _, t in rows]
    least = {}
    for (d, _), w in zip(rows, words, strict=True):
        for i in range(len(w) - size + 1):
            if d is not None:
                key = tuple(w[i : i + size])
                least[key] = min(least.get(key, d), d)
    out = []
    for (d, _), w in zip(rows, words, strict=True):
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - size + 1):
            first = least.get(tuple(w[i : i + size]))
            if first is not None and (d is None or first < d):
                gone[i : i + size] = True
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), int(gone.sum()), int(gone[0]) + int((np.diff(gone.astype(int)) == 1).sum()) if len(w) else 0, hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=repr)


def run(df, **more):
    return sorted([tuple(r) for r in substring_dedup.dedup(df, with_text=True, **more).collect()], key=repr)


def shared_passages(n=60):
    """Documents of few words that hold one of three passages, whole or in part, between words of their own."""
    passages = [[f"p{k}w{R.randint(0, 30)}" for _ in range(150)] for k in range(3)] + [["loop", "de"] * 60]
    out = []
    for i in range(n):
        own = lambda: [f"o{R.randint(0, 5)}" for _ in range(R.randint(0, 30))]
        p = R.choice(passages)
        a, z = sorted((R.randint(0, len(p)), R.randint(0, len(p))))
        out.append((R.randint(0, 40), "  ".join([*own(), *p[a:z], *own(), *R.choice(passages)[20:120], *own()])))
    return out


@pytest.mark.parametrize("hot", [500, 2, 0])
def test_substring(spark, hot):
    rows = [*shared_passages(), (None, " ".join(f"p{k}" for k in range(90))), (7, " ".join(f"p{k}" for k in range(80))), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    want = without_copies(rows, 50)
    assert run(df, hot=hot) == want
    assert sum(r[2] for r in want) > 1000


@pytest.mark.parametrize("size", [3, 9, 50])
def test_substring_hostile(spark, size):
    df, rows = hostile(spark)
    rows = [*rows, (None, "no id " + BASE)]
    assert run(df, size=size, hot=3) == without_copies(rows, size)
    assert run(empty(spark), size=size) == []


def test_substring_segments(spark, monkeypatch):
    rows = [(1, " ".join(f"w{k % 700}" for k in range(5000))), (2, "start " + " ".join(f"w{k % 700}" for k in range(90, 2500)) + " end"), (3, "x" * 5000 + " y")]
    assert run(spark.createDataFrame(rows, "doc_id long, text string"), size=50) == without_copies(rows, 50)
    text = " ".join(f"w{k}" for k in range(1000)).encode()
    for size in (1, 10, 1000, 10000):
        got = []
        for first, words, end in substring_dedup._segments(text, size, 7):
            assert words == text.split()[first : end + 7]
            got += words[: end - first]
        assert got == text.split()


def test_subtree_nodes_are_equal_strings():
    words = np.array([1, 2, 3, 1, 2, 3, 1, 9, 2, 3, 1, 2], np.uint64)
    node, place = substring_dedup.subtree(words, np.array([8, 4]), np.array([6, 2]), 3)
    strings = [tuple(words[i : i + 3].tolist()) for i in (*range(6), 8, 9)]
    of = {}
    for k, p in zip(node.tolist(), place.tolist(), strict=True):
        assert of.setdefault(k, strings[p]) == strings[p]
    assert len(of) == len(set(strings))


# fill-in-the-middle


def middle(doc_id, text):
    text = text or ""
    u = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, z = sorted((h1 % (len(u) + 1), h2 % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:z]), "".join(u[z:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, len(u), "plain", None, None, text
    out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 80 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, len(u), out[0], len(p), len(m), out[1]


ODD = ["<P>", "a <S> b", "<", "<<P", "M>", " x", "x ", "\n", "é　ü  \t ß\r\n", "<S <P M>", "\U0001f600 " * 300]


@pytest.mark.parametrize("every", [1, 3, 64])
def test_fill_in_middle(spark, every):
    df, rows = hostile(spark, TEXTS + ODD * 6)
    rows = [*rows, (None, "no id " + BASE)]
    made = fill_middle.transform(df, every=every)
    back = made.select("doc_id", "output", fill_middle.restored(F.col("output"), F.col("form")).alias("text")).collect()
    got = sorted([tuple(r) for r in made.collect()], key=repr)
    assert got == sorted([middle(d, t) for d, t in rows], key=repr)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in back) == sorted((d is None, d or 0, t or "") for d, t in rows)
    assert fill_middle.transform(empty(spark)).count() == 0


def test_checkpoints(monkeypatch):
    monkeypatch.setattr(kernels, "SEGMENT", 17)
    for text in ["", " ", "a", "a ", " a", "one  two\nthree ", "é 　x  ü " * 40, "w" * 100, "<P> x " * 30]:
        u = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
        for every in (1, 2, 5, 64):
            index = fill_middle.Checkpoints(text.encode(), every)
            assert index.n == len(u) and len(index.at) <= len(u) // every + 1
            for k in range(len(u) + 1):
                before = "".join(u[:k])
                assert index.locate(k) == (len(before.encode()), len(before))
