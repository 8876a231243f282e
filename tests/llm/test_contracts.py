"""Each query opN_ through the entry point, on a small folder of tables with awkward rows, against brute force."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from docgraph.llm import common, decontaminate, kernels, pieces, token_counts, toxicity

from . import test_operators as T


@pytest.fixture(scope="module")
def folder(spark, data, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    docs = common.table(spark, data, "documents")
    item = common.table(spark, data, "benchmark").where("item_id = 1").first().text
    odd = [(90001, None), (90002, ""), (90003, "mail me: a.b@c.de or 10.0.0.7, 4111 1111 1111 1111"), (90004, T.BASE), (90004, T.BASE + " tail"), (90005, f"so {item} so"), (90006, "12 34 !"), (None, T.BASE), (None, "you idiot"), (90007, "é" * 3000)]
    more = spark.createDataFrame(odd, "doc_id long, text string").select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"), F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars"))
    docs.unionByName(more).coalesce(1).write.parquet(f"{at}/documents.parquet")
    vectors = common.table(spark, data, "embeddings")
    first = vectors.orderBy("vec_id").first()
    e = spark.createDataFrame([(90001, None), (90002, [0.0] * len(first.embedding)), (first.vec_id, list(first.embedding[::-1])), (None, list(first.embedding))], "vec_id long, embedding array<double>")
    e.select("vec_id", F.col("embedding").cast(vectors.schema["embedding"].dataType).alias("embedding")).unionByName(vectors, allowMissingColumns=True).coalesce(1).write.parquet(f"{at}/embeddings.parquet")
    for t in ("labels", "benchmark"):
        common.table(spark, data, t).write.parquet(f"{at}/{t}.parquet")
    return at


@pytest.fixture(scope="module")
def documents(spark, folder):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def ran(spark, folder, name):
    return [r.asDict() for r in E.queries()[name](spark, folder).collect()]


def same(got, want):
    assert sorted(map(str, got)) == sorted(map(str, want))


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def test_op1(spark, folder, documents):
    got = ran(spark, folder, "op1_sharding")
    same([(r["doc_id"], r["text_md5"]) for r in got], [(d, None if t is None else hashlib.md5(t.encode()).hexdigest()) for d, t in documents])
    assert all(r["shards_ok"] and r["compacted"] for r in got)


def test_op2(spark, folder, documents):
    same([(r["doc_id"], r["n_shingles"], r["n_links"], r["component_id"]) for r in ran(spark, folder, "op2_ngram_join")], T.joined(documents))


def test_op3(spark, folder, documents):
    want = []
    for (d, t), spans in zip(documents, T.bootstrapped([t for _, t in documents]), strict=True):
        base = T.base(t)
        count = [sum(x.startswith(k + ":") for x in base.split(",")) for k in ("email", "ip", "card", "phone")]
        want.append((d, *count, hashlib.sha256(base.encode()).hexdigest(), spans))
    same([tuple(r[c] for c in ("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")) for r in ran(spark, folder, "op3_pii")], want)


def test_op4(spark, folder, documents):
    words = lambda t: kernels.words(*kernels.packed(T.pa.array([t or ""])), space=kernels.SIGNS)[0]
    texts, want = [words(t) for _, t in documents], []
    for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect():
        item = words(r.text)
        for k, (score, equal, _, _) in enumerate(decontaminate.align(item, texts) if len(item) >= 5 else []):
            if score >= 0.4 * 2 * len(item) and equal >= min(8, len(item)):
                want.append((documents[k][0], r.item_id, round(score / 2 / len(item), 9), equal))
    same([(r["doc_id"], r["item_id"], round(r["score"], 9), r["equal_words"]) for r in ran(spark, folder, "op4_decontamination")], want)
    assert any(d == 90005 for d, *_ in want)


def test_op5(spark, folder, documents):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").where("lang is not null").collect()}
    got = ran(spark, folder, "op5_language")
    same([(r["doc_id"], r["held_out"]) for r in got], [(d, held_out(d)) for d, _ in documents])
    letters = {d: any(c.isalpha() for c in t or "") for d, t in documents}
    assert all(0 <= r["score"] <= 1 and (r["lang_pred"] in lang.values() if letters[r["doc_id"]] else r["lang_pred"] == "und") for r in got if r["doc_id"] is not None)
    known = [r for r in got if r["held_out"] and r["doc_id"] in lang]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in known) >= 0.9 * len(known)


def test_op6(spark, folder, documents):
    same([tuple(r[c] for c in ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")) for r in ran(spark, folder, "op6_suffix_dedup")], T.without_repeats(documents, 200, False))


def test_op7(spark, folder, documents):
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    got = ran(spark, folder, "op7_sentencepiece")
    same([(r["doc_id"], r["n_tokens"], r["ids"]) for r in got], [(d, len(i := lib.encode(t or "")), i) for d, t in documents])
    same([(r["doc_id"], r["round_trip"]) for r in got], [(d, "▁" not in (t or "")) for d, t in documents])


def test_op8(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").select("vec_id", "embedding").collect()
    good = [k for k, r in enumerate(rows) if r.embedding and any(r.embedding)]
    near, low = T.links_of(np.array([rows[k].embedding for k in good], np.float64))
    got = ran(spark, folder, "op8_embedding_dedup")
    same([r["vec_id"] for r in got], [r.vec_id for r in rows])
    assert sum(r["n_links"] for r in got) >= 0.9 * near.sum()
    ids = [rows[k].vec_id for k in good]
    group = {}
    for k, g in enumerate(low):
        group[g] = T.least(group.get(g), ids[k])
    count = {}
    for r in got:
        count.setdefault(r["vec_id"], []).append(r)
        assert r["kept"] == (r["vec_id"] == r["component_id"])
    right = sum(any(r["component_id"] == group[low[k]] for r in count[i]) for k, i in enumerate(ids))
    assert right >= 0.9 * len(ids) and count[90001][0]["n_links"] == count[90002][0]["n_links"] == 0


def test_op9(spark, folder, documents):
    c = token_counts.Counter(token_counts.read_ranks(spark))
    n = lambda t: len(c.encoding.encode_ordinary(t))
    clean = lambda t: token_counts._CLEAN.sub(lambda m: "0" if m[0][0].isdigit() else "", t)
    same([(r["doc_id"], r["n_tokens"], r["n_tokens_edited"]) for r in ran(spark, folder, "op9_token_counts")], [(d, n(t or ""), n(clean(t or ""))) for d, t in documents])


def test_op10(spark, folder, documents):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect() if not held_out(r.doc_id)}
    rows = [(t or "", labels[d]) for d, t in documents if d in labels]
    weight = [1 / n for n in T.copies([t for t, _ in rows])]
    counts, total = {}, [sum(w for (_, y), w in zip(rows, weight, strict=True) if y == k) for k in (0, 1)]
    for (t, y), x in zip(rows, weight, strict=True):
        tokens = set(toxicity.TOKEN.findall(t.lower()))
        for f in tokens | {w[:n] + "*" for w in tokens for n in toxicity.STEMS if len(w) > n}:
            counts.setdefault(f, [0.0, 0.0])[y] += x
    features = sum(round(a + b, 6) >= 3 for a, b in counts.values())
    parts = toxicity.choose([(f, round(a, 6), round(b, 6)) for f, (b, a) in counts.items() if round(a + b, 6) >= 3], total[1], total[0], max(2, features))
    plain = toxicity.Scorer(*parts)
    scorer = toxicity.Scorer(*parts, toxicity.fit_weights(np.array([plain.features(t) for t, _ in rows]), np.array([y for _, y in rows], float), np.array(weight)))
    got = ran(spark, folder, "op10_toxicity")
    same([(r["doc_id"], r["held_out"], round(r["score"], 6), r["predicted"]) for r in got], [(d, held_out(d), round(s := scorer.score(t), 6), int(s >= 0.3)) for d, t in documents])


def test_every_query_is_registered():
    assert {f"op{k}" for k in range(1, 14)} == {n.split("_")[0] for n in E.queries() if n.startswith("op")} and "pipeline" in E.queries()
