"""The pipeline, stage by stage against plain Python, on a small corpus with every awkward row."""

import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from docgraph.llm import common, pieces, toxicity

MARKS = ["EMAIL", "IP", "CARD", "PHONE"]


@pytest.fixture(scope="module")
def corpus(spark, data, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("corpus"))
    docs = common.table(spark, data, "documents")
    item = common.table(spark, data, "benchmark").where("item_id = 0").first().text
    clean = "the quick level wall of nine doors and seven rooms stands here for a long time without any change at all today"
    odd = [(90001, None), (90002, ""), (90003, "mail me: a.b@c.de or 10.0.0.7, 4111 1111 1111 1111"), (90004, clean), (90005, clean), (90005, clean), (90006, clean + " " + item), (90007, "x" * 50_000), (None, "nobody")]
    extra = spark.createDataFrame(odd, "doc_id long, text string").withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.length("text").cast("long"))
    docs.unionByName(extra).write.parquet(f"{at}/documents.parquet")
    for t in ("labels", "benchmark"):
        common.table(spark, data, t).write.parquet(f"{at}/{t}.parquet")
    return at


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages(spark, corpus):
    from tests.llm.test_operators import base, first_of_each

    docs, out = common.table(spark, corpus, "documents"), {}
    columns = docs.columns
    for name, stage in P.STAGES:
        before, docs = docs, common.cut(stage(spark, docs, corpus), "test")
        out[name] = before.collect(), docs.collect()
        if name != "sentencepiece":
            assert docs.columns == columns

    before, after = out["toxicity"]
    labels = common.table(spark, corpus, "labels")
    s = toxicity.learn(common.table(spark, corpus, "documents").where(~common.held_out()), labels.where(~common.held_out()))
    key = lambda r: (r.doc_id is None, r.doc_id or 0, r.text or "")
    assert sorted((r for r in before if s.score(r.text) < toxicity.THRESHOLD), key=key) == sorted(after, key=key)

    before, after = out["ngram_join"]
    assert sorted(((r.doc_id, r.text) for r in after), key=str) == sorted(first_of_each([(r.doc_id, r.text) for r in before]), key=str)
    ids = {r.doc_id for r in after}
    assert 90004 in ids and None in ids and 90005 not in ids

    before, after = out["decontamination"]
    plain = lambda t: " ".join(re.findall(r"[a-z0-9\x80-￿]+", (t or "").lower()))
    items = [plain(r.text) for r in common.table(spark, corpus, "benchmark").collect()]
    whole = {r.doc_id for r in before if any(i and i in plain(r.text) for i in items)}
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert whole <= gone and 90006 in gone and not {90001, 90002, 90004, 90007, None} & gone

    before, after = out["pii"]
    new = {r.doc_id: r for r in after}
    assert len(after) == len(before)
    assert new[90001].text is None and new[90003].text == "mail me: <EMAIL> or <IP>, <CARD>" and new[90003].n_chars == len(new[90003].text)
    for r in before:
        assert not base(re.sub(r"<[A-Z]+>", "<>", new[r.doc_id].text or "")), r.doc_id
        if not base(r.text) and not re.search("[0-9]", r.text or ""):
            assert new[r.doc_id].text == r.text

    before, after = out["sentencepiece"]
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    assert {r.doc_id: r.ids for r in after} == {r.doc_id: lib.encode(r.text or "") for r in before}
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in after)

    assert {r.doc_id for r in P.run(spark, corpus).collect()} == {r.doc_id for r in after}


def test_empty(spark, corpus, tmp_path):
    for t in ("documents", "labels", "benchmark"):
        common.table(spark, corpus, t).where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
