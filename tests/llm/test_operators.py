"""The operators against brute force, on small tables and on texts that are null, empty, very long, tied or repeated."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from docgraph.llm import common, decontaminate, embedding_dedup, language, ngram_join, pieces, pii, sharding, suffix_dedup, token_counts, toxicity

# further columns with names that the operators use themselves
CLASHING = "kind string, key long, block long, a string, b string, n long, score double, rep long, size int, x binary, links long, component_id long, spans string, ids string, node string, lang string, path string, rows long"
EXTRA = [c.split()[0] for c in CLASHING.split(", ")]
R = random.Random(11)
WORDS = ["the", "of", "and", "Wall", "level", "idiot", "été", "größe", "x", "42", "a.b@c.de", "token"]


def prose(n):
    return " ".join(R.choice(WORDS) + R.choice(["", "", "ion", "s", "er", str(R.randint(0, 99))]) for _ in range(n))


BASE = prose(120)
LONG = " ".join(f"w{k % 9000}" for k in range(30000))
TEXTS = [None, "", " \n\t ", "one", "one two", "one  TWO", LONG, LONG + " end", BASE, BASE, BASE.replace("the", "The"), BASE + " tail", BASE[: len(BASE) // 2], "z" * 3000, "ab" * 500, "\U0001f600 é \x00 �", *[prose(R.randint(1, 60)) for _ in range(20)]]
TEXTS += [" ".join([*BASE.split()[:k], "changed", *BASE.split()[k + 1 :]]) for k in range(0, 110, 9)]


def hostile(spark, texts=TEXTS, null_id=True):
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)] + ([(4, texts[1]), (25, texts[8])] if texts is TEXTS else []) + ([(None, "no id " + BASE)] if null_id else [])
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for c in CLASHING.split(", "):
        name, kind = c.split()
        df = df.withColumn(name, F.lit(None).cast(kind))
    return df, [r for r in rows if r[0] is not None]


def empty(spark):
    return hostile(spark)[0].where("false")


# n-gram join


def word_sets(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i : i + 5]) for i in range(len(w) - 4)}


def grouped(rows):
    """Brute force over all pairs of (doc_id, text): the sets, and of each row its links and its group's first place."""
    s = [word_sets(t) for _, t in rows]
    parent, n = list(range(len(s))), [0] * len(s)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(s)):
        for j in range(i):
            if s[i] and s[j] and 100 * len(s[i] & s[j]) >= 80 * len(s[i] | s[j]):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
                n[i] += 1
                n[j] += 1
    return s, n, [root(i) for i in range(len(s))]


def joined(rows):
    """doc_id, n_shingles, n_links, component_id of each row."""
    s, n, root = grouped(rows)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root[i]] = least(low.get(root[i]), d)
    return sorted(((d, len(s[i]), n[i], low[root[i]]) for i, (d, _) in enumerate(rows)), key=lambda r: (r[0] is None, r))


def first_of_each(rows):
    """The rows of which each is the first of its group: smallest doc_id, none last, then place."""
    _, _, root = grouped(rows)
    best = {}
    for i, (d, _) in enumerate(rows):
        best[root[i]] = min(best.get(root[i], (True, 0, 1 << 40)), (d is None, d or 0, i))
    return [rows[i] for _, _, i in best.values()]


def least(a, b):
    return b if a is None else a if b is None else min(a, b)


@pytest.mark.parametrize("tile, sent", [(2, 3), (128, 128)])
def test_ngram_join(spark, tile, sent):
    docs, _ = hostile(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = ngram_join.join(docs, tile, sent).select("doc_id", "n_shingles", "n_links", "component_id").collect()
    assert sorted(map(tuple, got), key=str) == sorted(joined(rows), key=str)
    assert ngram_join.join(empty(spark)).count() == 0


def test_ngram_join_one_id_of_two_texts(spark):
    rows = [(1, BASE), (1, LONG), (2, BASE + " tail"), (3, LONG + " end"), (None, BASE), (None, "of a kind of its own here"), (None, "of a kind of its own here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = ngram_join.join(docs).orderBy("rid").collect()
    assert [(r.doc_id, r.n_links, r.component_id) for r in got] == [(1, 2, 1), (1, 1, 1), (2, 2, 1), (3, 1, 1), (None, 2, 1), (None, 1, None), (None, 1, None)]
    kept = ngram_join.first_of_each(docs.withColumn("rid", F.lit(1)).withColumn("RID0", F.lit(2))).collect()
    assert sorted((str(r.doc_id), r.text) for r in kept) == sorted([("1", BASE), ("1", LONG), ("None", rows[-1][1])])


@pytest.mark.parametrize("tile", [3, 128])
def test_ngram_join_common_passage(spark, tile):
    """One passage in every document, most of many; groups of near copies beside each other."""
    passage = " ".join(f"stock{k}" for k in range(40))
    rows = []
    for g in range(12):
        body = [f"g{g}w{k}" for k in range(60 if g % 3 else 6)]
        for c in range(R.randint(1, 7)):
            own = list(body)
            own[R.randrange(len(own))] = f"edit{c}"
            rows.append((len(rows), passage + " " + " ".join(own)))
    rows += [(len(rows) + k, passage) for k in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in ngram_join.join(docs, tile, 4).select("doc_id", "n_shingles", "n_links", "component_id").collect()) == joined(rows)


def test_divide_skip():
    for _ in range(300):
        n = R.randint(1, 30)
        lists = [sorted(R.sample(range(n), R.randint(1, n))) for _ in range(R.randint(1, 25))]
        least = np.array([R.randint(1, 12) for _ in range(n)])
        count = np.bincount(np.concatenate(lists), minlength=n)
        ids, total = ngram_join.divide_skip(lists, least, int(least.min()))
        order = np.argsort(ids)
        assert ids[order].tolist() == np.flatnonzero(count >= least).tolist() and total[order].tolist() == count[ids[order]].tolist()


@pytest.mark.parametrize("few", [0, 1 << 14])
def test_components_of_a_star(spark, few):
    edges = [(0, k) for k in range(1, 300)] + [(900, k) for k in range(500, 900)] + [(1000, 1001), (1001, 1002), (5, 5)]
    got = dict(map(tuple, common.components(spark.createDataFrame(edges, "a long, b long"), few=few).collect()))
    assert got == {**dict.fromkeys(range(300), 0), **dict.fromkeys(range(500, 901), 500), 1000: 1000, 1001: 1000, 1002: 1000}


# personal data

PATTERNS = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def base(text):
    out = []
    for rank, (kind, pattern) in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(c) if i % 2 == 0 else int(c) * 2 - 9 * (int(c) > 4) for i, c in enumerate(reversed(d))) % 10 == 0
            if {"email": True, "ip": all(int(x) < 256 for x in m[0].split(".")) if kind == "ip" else 0, "card": 12 <= len(d) <= 19 and luhn, "phone": 9 <= len(d) <= 15}[kind]:
                out.append((m.start(), rank, m.end(), kind))
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(out))


def test_pii_base_spans(spark):
    parts = ["a", "b.", "@", "..", ".", "-", "_", "%", "+", "1", "23", "4111111111111111", "255", "256.", " ", "  ", "é", "\U0001f600", "\n", "(", "+1 ", "555-", "x@y.zz", "1.2.3.4"]
    texts = [*TEXTS, "a" * 3000 + "@b.c" + ".d" * 4000, "1 " * 6000, "1" * 20000, *["".join(R.choice(parts) for _ in range(R.randint(1, 40))) for _ in range(1500)]]
    docs, rows = hostile(spark, texts)
    got = {r.doc_id: r.b for r in pii.extract(docs).select("doc_id", pii.joined(F.col("base")).alias("b")).collect()}
    assert [(d, got[d]) for d, t in rows if got[d] != base(t)] == [] and None in got
    assert pii.extract(empty(spark)).count() == 0


def test_pii_bootstraps(spark):
    seeds = [f'token = "{hashlib.md5(str(k).encode()).hexdigest()}"' for k in range(5)]
    docs = spark.createDataFrame(enumerate([*seeds, 'token = "AKIA99XYZ01"', "see chapter12345 of it", None]), "doc_id long, text string")
    got = {r.doc_id: r.s for r in pii.extract(docs).select("doc_id", pii.joined(F.col("spans")).alias("s")).collect()}
    assert got[5] == "key:9:20" and got[6] == "" and got[0] == "key:9:41"
    text = {r.doc_id: r.text for r in pii.redacted(docs).collect()}
    assert text[5] == 'token = "<KEY>"' and text[6] == "see chapter12345 of it" and text[7] is None


def bootstrapped(texts):
    """Brute force: all spans of each text, as the docstring of the module says."""
    rows, kinds = [], ["email", "ip", "card", "phone", "key"]
    for k, t in enumerate(texts):
        t = t or ""
        spans = [(int(x.split(":")[1]), kinds.index(x.split(":")[0]), int(x.split(":")[2])) for x in base(t).split(",") if x]
        found = [(s, r, e, False) for s, r, e in spans]
        for m in re.finditer(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*[0-9])[A-Za-z0-9_-]{6,}(?![A-Za-z0-9_@-])", t):
            if not any(s < m.end() and m.start() < e for s, _, e in spans):
                found.append((m.start(), 4, m.end(), True))
        for s, r, e, token in found:
            left = re.search(r"((?<![^\W\d])[^\W\d]{2,}[ \t]*[:=#]?[ \t]*[\"'(]?)$", t[:s])
            hit = re.sub(r"\.(?![A-Za-z0-9-])", "_", t[s:e] + ("x" if t[e : e + 1].isalnum() else "")) if r == 0 else t[s:e]
            rows.append((k, s, r, e, hit, left[1].lower() if left else "", token, token and bool(re.fullmatch("[0-9a-f]{32,64}", t[s:e]))))
    graph = {}
    for _, _, r, _, hit, pat, token, seed in rows:
        if pat:
            known = (r,) if not token else (4,) if seed else ()
            graph.setdefault((pat, hit), []).extend(known)
    graph = {k: min(v) if v else None for k, v in graph.items()}
    trusted, seen = {(hit, r): 1.0 for (_, hit), r in graph.items() if r is not None}, []
    seeds = dict(trusted)
    while True:
        score = {}
        for pat in {p for p, _ in graph}:
            hits = [h for p, h in graph if p == pat]
            for r in range(5):
                got = [trusted[h, r] for h in hits if (h, r) in trusted]
                least = 0.5 if re.search("[:=#\"'(]", pat) else 0.9
                if len(got) >= 3 and sum(got) / len(hits) >= least:
                    score.setdefault(pat, []).append((sum(got) / len(hits), -r))
        best = {p: max(v) for p, v in score.items()}
        if (sign := {p: -r for p, (_, r) in best.items()}) in seen:
            break
        seen.append(sign)
        trusted = dict(seeds)
        for (pat, hit), r in graph.items():
            if r is None and pat in best:
                x, n = max(best[p] for (p, h), q in graph.items() if h == hit and q is None and p in best)
                trusted[hit, -n] = max(x, trusted.get((hit, -n), 0))
    out = [[] for _ in texts]
    for k, s, r, e, _, pat, token, seed in rows:
        if not token or seed:
            out[k].append((s, r, e))
        elif pat in sign:
            out[k].append((s, sign[pat], e))
    return [",".join(f"{kinds[r]}:{s}:{e}" for s, r, e in sorted(x)) for x in out]


def test_pii_added_spans_against_brute_force(spark):
    r = random.Random(5)
    words = ["token", "id:", "key =", "Password: '", "see", "ref#", "user", "mail:", "x", "and", "(", "größe ", "a_b="]
    made = [lambda: hashlib.md5(str(r.random()).encode()).hexdigest(), lambda: f"AB{r.randint(0, 40):05d}", lambda: f"u{r.randint(0, 9)}@h{r.randint(0, 9)}.org", lambda: f"10.0.0.{r.randint(0, 20)}", lambda: "word", lambda: f"+49 30 {r.randint(1000000, 1000020)}", lambda: "Z" * 70 + "7"]
    texts = [" ".join(r.choice(words) + r.choice(["", " "]) + r.choice(made)() for _ in range(r.randint(1, 12))) + r.choice(["", ".", "\n"]) for _ in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.s for r in pii.extract(docs).select("doc_id", pii.joined(F.col("spans")).alias("s")).collect()}
    want = bootstrapped(texts)
    assert [(texts[k], got[k], want[k]) for k in range(len(texts)) if got[k] != want[k]] == []
    assert sum("key" in w for w in want) > sum("md5" in t for t in texts)


def test_pii_redacts_rows_of_one_id_beside_clashing_names(spark):
    rows = [(1, "a@b.cd"), (1, "a@b.cd"), (1, "at 10.0.0.1 or a@b.cd,x"), (None, "+1 555 123 4567"), (2, None), (3, ""), (4, "é" * 9000 + " a@b.cd " + "x" * 5000 + " 1.2.3.4"), (5, "4111 1111 1111 1111@x.yz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    for c in ["extra", "extra_id", "rid", "rid0", "runs", "Runs0", "spans", "a b"]:
        docs = docs.withColumn(c, F.lit(c))
    got = pii.redacted(docs)
    assert got.columns == docs.columns
    assert [r.text for r in got.collect()] == ["<EMAIL>", "<EMAIL>", "at <IP> or <EMAIL>,x", "<PHONE>", None, "", "é" * 9000 + " <EMAIL> " + "x" * 5000 + " <IP>", "<CARD>"] and got.where("rid <> 'rid' or extra <> 'extra'").count() == 0


def test_pii_of_a_very_long_text(spark):
    import time

    tokens = " ".join(f"id: ab{k:06d}x" for k in range(80_000)) + " " + " ".join(f"u{k}@host.org" for k in range(5_000))
    docs = spark.createDataFrame([(1, tokens), (2, "id: " + "1f" * 16)], "doc_id long, text string")
    began = time.time()
    assert {r.doc_id: r.n for r in pii.extract(docs).select("doc_id", F.size("base").alias("n")).collect()} == {1: 5000, 2: 0}
    assert pii.redacted(docs).where("text like '%u4999@%' or text not like '%>%'").count() == 0 and time.time() - began < 60


# suffix arrays


def without_repeats(rows, size, first):
    seen, out = {}, []
    raw = [(d, (t or "").encode()) for d, t in rows]
    for k, (d, b) in enumerate(raw):
        for i in range(len(b) - size + 1):
            seen.setdefault(b[i : i + size], []).append((k, i))
    for k, (d, b) in enumerate(raw):
        gone = bytearray(len(b))
        for i in range(len(b) - size + 1):
            at = seen[b[i : i + size]]
            if len(at) > 1 and (not first or min(at) != (k, i)):
                gone[i : i + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((d, len(b), sum(gone), len(re.findall(b"\1+", gone)), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("keep, hot, size", [("none", 1000, 200), ("first", 1000, 200), ("none", 0, 200), ("first", 0, 200), ("first", 1000, 7)])
def test_suffix_dedup(spark, keep, hot, size):
    texts = [t for t in TEXTS if t is None or len(t) < 4000]
    docs, _ = hostile(spark, texts)
    docs = docs.union(docs.where("doc_id < 40").limit(12).withColumn("text", F.concat(F.lit("of one id "), "text")))  # other texts of ids that are there
    docs = common.cut(docs.coalesce(1), "test")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = [tuple(r) for r in suffix_dedup.dedup(docs, size, keep, hot).collect()]
    assert sorted(got, key=str) == sorted(without_repeats(rows, size, keep == "first"), key=str)
    assert suffix_dedup.dedup(empty(spark)).count() == 0


def test_suffix_dedup_of_repeated_rows_and_long_runs(spark):
    docs = spark.createDataFrame([(1, "q" * 400_000), (2, prose(80)), (2, None), (3, "é" * 500)], "doc_id long, text string").where("text is not null")
    got = {r.doc_id: (r.n_bytes, r.n_removed) for r in suffix_dedup.dedup(docs.union(docs.where("doc_id = 2")), keep="none").collect()}
    assert got[1] == (400_000, 400_000) and got[2][0] == got[2][1] and got[3] == (1000, 1000)


def test_longest_previous_factor():
    for _ in range(50):
        text = np.frombuffer("".join(R.choice("ab") for _ in range(R.randint(12, 60))).encode(), np.uint8)
        rank = suffix_dedup.suffix_ranks(text, 9)
        raw = text.tobytes()
        want = [9 if raw.find(raw[i : i + 9]) < i else 0 for i in range(len(raw) - 8)]
        assert suffix_dedup.longest_previous_factor(rank, np.arange(len(rank)), 9).tolist() == want
    before, behind = suffix_dedup.smaller_neighbours(np.array([3, 1, 2, 0, 5]))
    assert before.tolist() == [-1, -1, 1, -1, 3] and behind.tolist() == [1, 3, 3, 5, 5]


# pieces and tokens


@pytest.fixture(scope="module")
def vocabulary():
    with open(pieces.MODEL, "rb") as f:
        return pieces.load(f.read())


def test_sentencepiece_equals_the_library(vocabulary):
    import sentencepiece

    lib, e = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL), pieces.Encoder(vocabulary, cache=50)
    parts = [*"aabbcde  \n\t.,!0123éßñ▁中文\U0001f600", "the", " of ", "tion", "    ", "<s>", "<0x41>"]
    texts = [*TEXTS, *["".join(R.choice(parts) for _ in range(R.randint(0, 60))) for _ in range(2000)]]
    ids, n, exact = e.encode_batch(texts)
    at = np.concatenate([[0], np.cumsum(n)])
    for k, t in enumerate(texts):
        own = ids[at[k] : at[k + 1]].tolist()
        assert own == lib.encode(t or "") and e.decode(own) == (t or "").replace("▁", " ")
        assert exact[k] == ("▁" not in (t or ""))


def test_viterbi_of_a_unigram_model_is_the_best_path():
    v = pieces.Vocabulary(["<unk>", "▁", "a", "b", "ab", "ba", "aab", "▁a"], [0, -3, -2.5, -2.5, -3, -3.5, -5.1, -4], [False, *[True] * 7], [-1] * 8, 0, False)
    e = pieces.Encoder(v)

    def best(t):
        if not t:
            return 0.0
        return max((v.scores[i] + best(t[len(p) :]) for i, p in enumerate(v.pieces) if i and t.startswith(p)), default=-np.inf)

    for _ in range(200):
        t = "▁" + "".join(R.choice("ab") for _ in range(R.randint(0, 9)))
        ids = e.viterbi(t)
        assert "".join(v.pieces[i] for i in ids) == t and sum(v.scores[i] for i in ids) == pytest.approx(best(t))


def test_sentencepiece_frames(spark, vocabulary):
    docs, rows = hostile(spark)
    got = pieces.encode(docs, vocabulary)
    back = {r.doc_id: r.text for r in pieces.decode(got, vocabulary).collect()}
    assert all(back[d] == (t or "") for d, t in rows) and got.where("n_tokens <> size(ids)").count() == 0 and got.count() == docs.count()
    assert pieces.encode(empty(spark), vocabulary).count() == 0


def test_token_counts(spark):
    ranks = token_counts.read_ranks(spark)
    c = token_counts.Counter(ranks)
    for _ in range(800):
        t = "".join(R.choice([*"ab c  \n1.,'", "'s", "é", " ", "the "]) for _ in range(R.randint(0, 800)))
        p = sorted(R.sample(range(len(t) + 1), min(len(t) + 1, 2 * R.randint(0, 6))))
        edits = [(p[k], p[k + 1], R.choice(["", "x", " 's", None])) for k in range(0, len(p) - 1, 2)]
        chars, tokens, _ = token_counts.leaves(t, c)
        new, tree, _ = token_counts.edited(t, chars, tokens, edits[::-1], c)
        want = t
        for s, e, r in reversed(edits):
            want = want[:s] + (r or "") + want[e:]
        assert new == want and tree.tokens[1] == len(c.encoding.encode_ordinary(want)) and tree.chars[1] == len(want)
    with pytest.raises(ValueError):
        token_counts.edited("abcdef", [6], [1], [(0, 3, ""), (2, 4, "")], c)
    docs, rows = hostile(spark)
    got = {r.doc_id: r for r in token_counts.recount(docs, ranks, token_counts.cleaning).collect()}
    for d, t in rows:
        new = token_counts._CLEAN.sub(lambda m: "0" if m[0][0].isdigit() else "", t or "")
        assert (got[d].n_tokens, got[d].n_tokens_edited) == (len(c.encoding.encode_ordinary(t or "")), len(c.encoding.encode_ordinary(new)))
    state = token_counts.count(docs, ranks)
    edit = F.array(F.struct(F.lit(0).alias("start"), F.lit(2).alias("end"), F.lit("Q").alias("replacement"))).alias("edits")
    kept = docs.where("doc_id is not null").dropDuplicates(["doc_id"]).select("doc_id", "text", edit).join(state.dropDuplicates(["doc_id"]), "doc_id")
    for r in token_counts.recount(kept, ranks).collect():
        t = dict(rows)[r.doc_id] or ""
        assert r.n_tokens_edited == len(c.encoding.encode_ordinary("Q" + t[2:]))
    assert token_counts.count(empty(spark), ranks).count() == 0


# embeddings


def test_embedding_dedup(spark):
    g = np.random.Generator(np.random.PCG64(3))
    centre = g.standard_normal((40, 16))
    x = np.concatenate([c + 0.12 * g.standard_normal((R.randint(1, 60), 16)) for c in centre])
    x = np.concatenate([x, x[:30], 5 * x[:5]])
    rows = [(k, v.tolist()) for k, v in enumerate(x)] + [(9000, None), (9001, [0.0] * 16), (9002, [1.0] * 15 + [float("nan")]), (9003, []), (9004, [1.0] * 15 + [None]), (9005, [float("inf")] * 16), (9006, [1.0] * 8), (9007, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("x", F.lit(1)).withColumn("label", F.lit(1))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    for part in (64, 2048):
        got = {r.vec_id: r for r in embedding_dedup.link(df, part=part).collect()}
        n = np.array([got[k].n_links for k in range(len(x))])
        assert (n <= near.sum(1)).all() and n.sum() >= 0.9 * near.sum() and len(got) == len(rows)
        assert all(got[k].n_links == 0 and got[k].component_id == k for k in range(9000, 9006)) and got[9007].component_id == 9006
        assert all(got[int(j)].component_id <= int(j) for j in range(len(x)))
    assert embedding_dedup.link(df.where("false")).count() == 0


def links_of(x):
    """Brute force: links and least reachable place of each of the vectors."""
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    low = np.arange(len(x))
    while True:
        new = np.array([min([low[i], *low[near[i]]]) for i in range(len(x))])
        if (new == low).all():
            return near, low
        low = new


def test_embedding_dedup_rows_of_one_id_or_none(spark):
    e = np.eye(4)
    rows = [(1, e[0]), (1, e[1]), (2, e[0]), (3, 2 * e[0]), (4, e[1]), (None, e[2]), (None, e[2]), (None, e[1]), (7, e[3])]
    df = spark.createDataFrame([(k, v.tolist()) for k, v in rows], "vec_id long, embedding array<double>").coalesce(1)
    got = [(r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.link(df).orderBy("rid").collect()]
    assert got == [(1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 2, 1), (None, 1, None), (None, 1, None), (None, 2, 1), (7, 0, 7)]


def test_embedding_dedup_grows_large_leaves_where_they_lie(spark):
    g = np.random.Generator(np.random.PCG64(9))
    x = np.concatenate([c + 0.1 * g.standard_normal((R.randint(1, 9), 16)) for c in g.standard_normal((400, 16))])
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    near, low = links_of(x)
    got = {r.vec_id: r for r in embedding_dedup.link(df, sample=40, most=100).collect()}
    n = np.array([got[k].n_links for k in range(len(x))])
    assert (n <= near.sum(1)).all() and n.sum() >= 0.9 * near.sum()
    assert np.mean([got[k].component_id == low[k] for k in range(len(x))]) >= 0.9


def test_embedding_dedup_of_a_dense_group_larger_than_a_leaf(spark):
    g = np.random.Generator(np.random.PCG64(5))
    x = np.concatenate([g.standard_normal(64) + 0.32 * g.standard_normal((2500, 64)), g.standard_normal(64) + 0.4 * g.standard_normal((1300, 64)), g.standard_normal((400, 64))])
    x /= np.linalg.norm(x, axis=1)[:, None]
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    for part in (100, 2048):
        got = {r.vec_id: r.n_links for r in embedding_dedup.link(df, part=part).collect()}
        assert [got[k] for k in range(2500)] == near.sum(1)[:2500].tolist() and sum(got.values()) >= 0.999 * near.sum()


def test_embedding_dedup_with_a_common_direction(spark):
    """All vectors lie near all centres; a vector still goes to few balls, and no link of the groups is lost."""
    g = np.random.Generator(np.random.PCG64(21))
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    common_, own = unit(g.standard_normal(64)), unit(g.standard_normal((20, 64)))
    x = unit(np.repeat(0.75**0.5 * common_ + 0.25**0.5 * own, 60, axis=0) + 0.018 * g.standard_normal((1200, 64)))
    middle, left = embedding_dedup.centres(x, 30, 0.9)
    core, angle = embedding_dedup.cores(x, middle, 0.9)
    wide = (embedding_dedup.cosines(x, middle) >= 2 * 0.9**2 - 1).sum(1).mean()
    ring = np.floor(angle * embedding_dedup.RINGS / np.arccos(0.9))
    rings = np.array([(k, angle[own].min(), angle[own].max()) for k in range(len(middle)) for r in set(ring[core == k]) if (own := (core == k) & (ring == r)).any()])
    balls = embedding_dedup.balls(x, core, middle, rings, 0.9)
    assert len(middle) == 20 and wide > 15 and np.mean([len(b) for b in balls]) < 3
    near, low = links_of(x)
    missed = [(i, j) for i, j in zip(*np.nonzero(near), strict=True) if core[i] >= 0 and core[i] not in balls[j]]
    assert not missed
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {r.vec_id: r for r in embedding_dedup.link(df).collect()}
    assert [got[k].n_links for k in range(len(x))] == near.sum(1).tolist() and [got[k].component_id for k in range(len(x))] == low.tolist()


# decontamination


def test_decontamination(spark):
    items = [" ".join(f"item{k}word{i}" for i in range(30)) for k in range(12)]
    near = items[3].split()
    near[10], near[20] = "other", "words"
    texts = [f"{prose(50)} {items[0]} {prose(50)}", f"start, {'! '.join(near)}", items[5].upper(), " ".join(items[7].split()[:6]), prose(200), None, "", items[2] + " " + items[1], items[0]]
    docs, rows = hostile(spark, texts)
    tests = spark.createDataFrame([*enumerate(items), (50, None), (51, "few words"), (None, items[4])], "item_id long, text string")
    for block in (8 << 20, 2000):
        got = {(r.doc_id, r.item_id): r for r in decontaminate.find(docs, tests, block=block).collect()}
        assert set(got) == {(1, 0), (4, 3), (7, 5), (22, 2), (22, 1), (25, 0)}
        assert got[1, 0].score == 1 and texts[0].encode()[got[1, 0].first_byte : got[1, 0].end_byte].decode() == items[0] and 0.7 < got[4, 3].score < 1
    assert decontaminate.find(empty(spark), tests).count() == 0 and decontaminate.find(docs, tests.where("false")).count() == 0


def test_decontamination_finds_what_a_full_alignment_finds(spark):
    items = [" ".join(R.choice(["the", "of", "a", f"k{R.randint(0, 400)}"]) for _ in range(R.randint(16, 40))) for _ in range(25)]
    texts = [f"{prose(40)} {i} {prose(40)}" for i in items[:5]]  # exact copies, so that no gram of these is rare
    for i in items:
        for share in (0.2, 0.25, 0.3, 0.35, 0.4):
            kept = [R.choice([f"e{R.randint(0, 999)}", "", f"{x} more"]) if R.random() < share else x for x in i.split()]
            texts.append(f"{prose(30)} {' '.join(kept)} {prose(30)}")
        texts.append(" ".join(x if k % 3 else f"e{k}" for k, x in enumerate(i.split())))
        texts.append(" zz ".join(i.split()))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find(docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")).collect()}
    number = {}
    words = lambda t: np.array([number.setdefault(x, len(number)) for x in re.findall(r"[0-9a-z\x80-\U0010ffff]+", t.lower())], np.uint64)
    want = set()
    for k, i in enumerate(map(words, items)):
        for d, (score, equal, _, _) in enumerate(decontaminate.align(i, [words(t) for t in texts])):
            if score >= 0.4 * 2 * len(i) and equal >= 8:
                want.add((d, k))
    assert got == want and len(want) > 100


def test_alignment_is_smith_waterman():
    def plain(a, b):
        """The best of (score, -first place, equal words)."""
        none = (0, -len(b), 0)
        h, top = [[(0, -j, 0) for j in range(len(b) + 1)] for _ in range(len(a) + 1)], none
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                s, at, n = h[i][j] if h[i][j][0] > 0 else (0, -j, 0)
                ways = [(s + 2, at, n + 1) if x == y else (s - 1, at, n), *((s - 1, at, n) for s, at, n in (h[i][j + 1], h[i + 1][j]))]
                h[i + 1][j + 1] = max(ways) if max(ways)[0] > 0 else (0, -j - 1, 0)
                top = max(top, h[i + 1][j + 1]) if h[i + 1][j + 1][0] > 0 else top
        return top

    for _ in range(200):
        a, bs = [R.randint(0, 4) for _ in range(R.randint(1, 12))], [[R.randint(0, 4) for _ in range(R.randint(1, 15))] for _ in range(3)]
        got = decontaminate.align(np.array(a, np.uint64), [np.array(b, np.uint64) for b in bs])
        assert [(s, -i, e) if s else (0, 0, 0) for s, e, i, _ in got] == [x if (x := plain(a, b))[0] else (0, 0, 0) for b in bs]
        assert all(plain(a, b[i:j])[0] == s for (s, _, i, j), b in zip(got, bs, strict=True) if s)


def test_decontamination_of_long_repeating_texts_and_short_items(spark):
    """One text repeats an item so often that its windows are one; it is found, in pieces of bounded size."""
    items = [" ".join(f"q{k}w{i}" for i in range(n)) for k, n in enumerate((30, 5, 6, 4, 9))]
    half = " ".join(items[0].split()[:15])
    texts = [f"{half} between these words " * 4000, f"x {items[1]} y", "q1w0 q1w1 q1w2 q1w4", f"{items[2]}, {items[3]}", items[4].replace("q4w4", "other"), *[f"{prose(20)} {half}" for _ in range(60)]]
    docs = spark.createDataFrame([(None if k == 3 else 7 if k < 3 else k, t) for k, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    tests = spark.createDataFrame([(k or None, t) for k, t in enumerate(items)], "item_id long, text string")
    got = decontaminate.find(docs, tests).orderBy("rid", "equal_words").collect()
    assert [(r.doc_id, r.item_id, r.equal_words) for r in got] == [(7, None, 15), (7, 1, 5), (None, 3, 4), (None, 2, 6), (4, 4, 8), *[(k, None, 15) for k in range(5, 65)]]
    assert got[0].first_byte == 0 and [r.doc_id for r in decontaminate.clean(docs.withColumn("rid0", F.lit(1)).withColumn("item_id", F.lit(1)), tests).collect()] == [7]
    cut = decontaminate.pieces([(0, 5, 1000), (1, 0, 10)], 20)
    assert cut[-1] == (1, 0, 10) and max(z - a for _, a, z in cut) <= 80 and all(any(a <= k and k + 20 <= z for d, a, z in cut if not d) for k in range(5, 981))
    assert all(len(b) * max(z - a for _, a, z in b) <= 400 for b in decontaminate.batches(cut, 400)) and sorted(sum(decontaminate.batches(cut, 400), [])) == sorted(cut)


# classifiers


def test_language(spark, data):
    docs = common.table(spark, data, "documents")
    model = language.learn(docs.where(~common.held_out()))
    got = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(common.held_out())
    assert got.where("lang = lang_pred").count() >= 0.95 * got.count() and max(map(len, model.families)) > 1
    docs, _ = hostile(spark)
    r = {x.text: x for x in language.identify(docs, model).join(docs.select("doc_id", "text"), "doc_id").collect()}
    assert all((r[t].lang_pred, r[t].score) == ("und", 0.0) for t in ("", " \n\t ")) and all(0 <= x.score <= 1 for x in r.values())
    assert language.identify(empty(spark), model).count() == 0 and language.learn(empty(spark)).languages == []
    many = language.learn(docs.union(docs).union(docs).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "a").otherwise("b")))
    assert many.languages == ["a", "b"]
    none = language.learn(docs.withColumn("lang", F.lit(None).cast("string")))
    assert none.predict(language.counts("abc")) == ("und", 0.0)
    one = language.learn(docs.withColumn("lang", F.lit("en")))
    assert one.predict(language.counts("abc")) == ("en", 1.0) and one.predict(language.counts("12 !")) == ("und", 0.0)


def test_toxicity_learns_and_understands_clauses(spark):
    clean = [prose(30).replace("idiot", "friend") for _ in range(120)]
    rows = [(k, t + (" you idiot. you moron!" if k % 3 == 0 else " not an idiot." if k % 10 == 1 else "")) for k, t in enumerate(clean)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k, _ in rows], "doc_id long, toxic int")
    s = toxicity.learn(docs, labels)
    assert s.score("such a moron you are") > 0.3 > max(s.score("a friend of the level"), s.score(""), s.score(None))
    hard, _ = hostile(spark)
    got = toxicity.score(hard, s)
    assert got.count() == hard.count() and got.where("score < 0 or score > 1 or predicted <> int(score >= 0.3)").count() == 0
    assert toxicity.score(empty(spark), s).count() == 0
    bare = toxicity.learn(docs, labels.where("toxic = 0"))
    assert bare.score("moron") < 0.3


def test_toxic_clauses():
    scorer = toxicity.Scorer({"idiot": 1.0}, {"imbec": 2.0})
    labels = lambda t: [k for k, v in zip(toxicity.LABELS, scorer.features(t), strict=True) if v]
    f = "You idiot. He is not an idiot! She said idiot; I will hurt them. idiotic"
    assert labels(f) == ["insult_target", "insult_negated", "insult_reported", "threat_target"]
    # order and scope: a negation behind the insult, or far before it, does not reach it; a verb of saying behind it does
    assert labels("idiot, not so") == ["insult"] and labels("not one of these many long words here idiot") == ["insult"]
    assert labels("the idiot, wrote the paper") == ["insult_reported"] and labels("what an imbecile you are") == ["insult_target"]
    assert labels("they will never hurt") == ["threat_negated"] and labels("kill the process") == ["threat"] and labels("not. idiot") == ["insult"]
    assert labels("imbecile idiot")[0] == "insult" and scorer.features("imbecile idiot")[0] == pytest.approx(np.log1p(3.0))


def test_toxic_grammar_is_the_composition_of_its_parts():
    weights = {k: float(i) for i, k in enumerate(toxicity.LABELS)}
    parts = [toxicity.negation(), toxicity.reporting(), toxicity.target(), toxicity.clause(weights)]
    whole = toxicity.composed(toxicity.composed(toxicity.composed(*parts[:2]), parts[2]), parts[3])
    for _ in range(200):
        states, at, total = [p.start for p in parts], whole.start, 0.0
        for symbol in [R.choice(toxicity.PLAIN) for _ in range(12)]:
            at, out, x = whole.arcs[at, symbol]
            for i, p in enumerate(parts):
                states[i], symbol, y = p.arcs[states[i], symbol]
                x -= y
            assert out == symbol and x == 0


def copies(texts):
    """Brute force: of each text, the size of its group of near copies."""
    made, parent = [set(toxicity.bands(t or "")) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if made[i] & made[j]:
                parent[root(i)] = root(j)
    of = [root(i) for i in range(len(texts))]
    return [of.count(x) for x in of]


def test_toxicity_weighs_near_copies_as_one(spark):
    text = prose(60)
    assert toxicity.bands(text) == toxicity.bands(f" {text.replace('W', 'w')}\n") and toxicity.bands("") == [] == toxicity.bands(" ")
    texts = [text, text, text + " and more of it", *[f"{prose(20)} {k}" for k in range(30)], "", None, "", *[f"{text} {k}" for k in range(40)]]
    assert copies(texts)[:3] == [43] * 3 and copies(texts)[3:33] == [1] * 30
    got = toxicity._weighted(spark.createDataFrame([(t, k % 2) for k, t in enumerate(texts)], "text string, toxic int")).collect()
    assert sorted((r.text or "", round(1 / r.weight)) for r in got) == sorted((t or "", n) for t, n in zip(texts, copies(texts), strict=True))
    assert toxicity.stands_out(6, 0, 0.1, 50_000) and not toxicity.stands_out(3, 0, 0.1, 50_000) and not toxicity.stands_out(1, 30, 0.1, 10)


# sharding


def test_sharding(spark):
    docs, _ = hostile(spark)
    store = sharding.Store(spark, common.scratch(spark, "test"), target=60_000, fan_in=3, least=1000)
    assert store.read() is None and store.compact() == 0
    for _ in range(7):
        store.append(docs.withColumn("nothing", F.lit(None)), most_rows=20)
    before, names = store.version(), {r.path for r in store.manifest().select("path").collect()}
    assert store.settle() > before
    assert store.read().where("doc_id = 25").count() == 14 and store.read().count() == 7 * docs.count() and set(docs.columns) < set(store.read().columns)
    left = store.manifest().where(F.col("bytes") < store.target // 2).groupBy("tier").count()
    assert left.where("count >= 3").count() == 0 and store.manifest().count() < len(names)
    with pytest.raises(FileExistsError):
        store.commit(store.manifest(), store.schema(), store.version() - 1)
    assert store.append(docs) == store.version()
    lone = sharding.Store(spark, common.scratch(spark, "test"))
    lone.append(empty(spark))
    assert lone.settle() == 1 and lone.read().count() == 0 and lone.read().columns == docs.columns


def test_sharding_beside_another_writer(spark, monkeypatch):
    root = common.scratch(spark, "test")
    one, two = (sharding.Store(spark, root, target=60_000, fan_in=2, least=1000) for _ in range(2))
    rows = spark.range(40).selectExpr("id as doc_id", "repeat('x', 50) as text")
    for _ in range(3):
        one.append(rows, most_rows=10)
    # another writer commits, compacts and vacuums while this one has written its shards but not committed them
    commit, calls = two.commit, []

    def late(*a):
        if not calls:
            calls.append(one.append(rows.where("doc_id < 5")))
            one.settle()
            one.vacuum()
        return commit(*a)

    monkeypatch.setattr(two, "commit", late)
    assert two.append(rows) == two.version() and two.read().count() == 40 * 4 + 5
    # a compaction whose base expires plans again
    calls.clear()
    for _ in range(2):
        one.append(rows, most_rows=10)
    assert two.settle() == one.version() and one.read().count() == 40 * 6 + 10
    # files of no version go with age, dead files of a folder that lives in part go at once
    one.vacuum(age=-60)
    there = {r.path.rsplit("/", 1)[-1] for r in spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(f"{root}/data").select("path").collect()}
    assert there == {r.path.rsplit("/", 1)[-1] for r in one.manifest().select("path").collect()} and one.versions() == [one.version()]


def test_sharding_schema_grows(spark):
    store = sharding.Store(spark, common.scratch(spark, "test"))
    store.append(spark.sql("select 1L as doc_id, 'a' as text"))
    store.append(spark.sql("select 2L as doc_id, 7 as b"))
    store.append(spark.sql("select 3L as doc_id, 'c' as text"))
    assert sorted(map(tuple, store.read().collect())) == [(1, "a", None), (2, None, 7), (3, "c", None)]
    assert store.settle() >= 3 and store.read().columns == ["doc_id", "text", "b"]
    for bad in ("select 'x' as doc_id", "select 1L as DOC_ID"):
        with pytest.raises(ValueError):
            store.append(spark.sql(bad))
    assert store.read().count() == 3


@pytest.mark.parametrize("few", [0, 1 << 14])
def test_components(spark, few):
    edges = [(R.randint(0, 300), R.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1060)] + [(2000, k) for k in range(2001, 2100)] + [(None, 1), (7, 7)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    got = {r.node: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long"), few=few).collect()}
    assert got == {x: root(x) for x in parent}


def test_phrases_of_few_words_are_found(spark):
    docs = spark.createDataFrame([(1, "say: Blue, whales sing!"), (2, "blue the whales sing"), (3, "BLUE-WHALES-SING"), (4, None), (5, "whales"), (5, "so blue")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "blue whales sing"), (2, "Whales!"), (3, "blue whales sing."), (4, "?"), (5, None), (6, "so blue whales sing")], "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.score, r.equal_words, r.first_byte, r.end_byte) for r in decontaminate.find(docs, items).collect())
    assert got == [(1, 1, 1.0, 3, 5, 22), (1, 2, 1.0, 1, 11, 17), (1, 3, 1.0, 3, 5, 22), (2, 2, 1.0, 1, 9, 15), (3, 1, 1.0, 3, 0, 16), (3, 2, 1.0, 1, 5, 11), (3, 3, 1.0, 3, 0, 16), (5, 2, 1.0, 1, 0, 6)]


def test_language_of_rows_that_share_an_id(spark):
    """The text that is learned keeps its own label, whichever of the rows of a doc_id it is."""
    text = {"en": "the quick brown fox jumps over the lazy dog and the cat", "de": "der schnelle braune Fuchs springt ueber den faulen Hund und die Katze"}
    rows = [(i, f"{text[k]} {i}", k) for i in range(40) for k in ("en", "de")]
    seen = {}

    def fit(vectors, raw, names):
        seen["rows"] = sorted(zip(map(bytes, raw), names, strict=True))
        return language.Model(["de", "en"], [[0, 1]], np.zeros((1, language.BINS)), {}, 1.0)

    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept, language.fit = language.fit, fit
    try:
        language.learn(df)
    finally:
        language.fit = kept
    want = {bytes(language.counts(t).astype(np.float32)): k for _, t, k in rows}
    assert len(seen["rows"]) == 40 and all(want[c] == k for c, k in seen["rows"])
