"""Results stay the same when the cluster changes between two jobs, and so the way in which files are split."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from docgraph.llm import common, decontaminate, ngram_join, pii, suffix_dedup, substring_dedup


@pytest.fixture(scope="module")
def docs(spark, data, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("many"))
    mail = F.concat(F.col("text"), F.lit(" contact mail "), F.col("doc_id").cast("string"), F.lit("@example.org"))
    rows = spark.read.parquet(f"{data}/documents.parquet").withColumn("text", F.when(F.col("doc_id") % 3 == 0, mail).otherwise(F.col("text")))
    rows.repartition(24).write.parquet(f"{at}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{data}/{t}.parquet").write.parquet(f"{at}/{t}.parquet")
    return at


RUNS = {
    "pii": lambda d, b: pii.extract(d).select("doc_id", pii.joined(F.col("spans")).alias("s")),
    "redacted": lambda d, b: pii.redacted(d),
    "suffix_dedup": lambda d, b: suffix_dedup.dedup(d, keep="none"),
    "substring_dedup": lambda d, b: substring_dedup.dedup(d),
    "ngram_join": lambda d, b: ngram_join.first_of_each(d),
    "decontamination": lambda d, b: decontaminate.clean(d, b),
}


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", RUNS)
def test_other_split_between_jobs(spark, docs, name, monkeypatch):
    table = lambda: (spark.read.parquet(f"{docs}/documents.parquet"), spark.read.parquet(f"{docs}/benchmark.parquet"))
    want = rows(RUNS[name](*table()))
    cut, seen = common.cut, []

    def shrinking(df, what):
        out = cut(df, what)
        seen.append(what)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "1")
        return out

    monkeypatch.setattr(common, "cut", shrinking)
    spark.conf.set("spark.sql.leafNodeDefaultParallelism", "12")
    try:
        found = RUNS[name](*table())
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", "1")  # whatever was cut, the last job sees another cluster
        assert rows(found) == want
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert want


def test_pipeline_with_another_split(spark, docs, monkeypatch):
    want = rows(corpus_pipeline.run(spark, docs))
    cut, n = common.cut, []

    def turning(df, what):
        out = cut(df, what)
        n.append(what)
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", str(1 + 11 * (len(n) % 2)))
        return out

    monkeypatch.setattr(common, "cut", turning)
    try:
        assert rows(corpus_pipeline.run(spark, docs)) == want
    finally:
        spark.conf.unset("spark.sql.leafNodeDefaultParallelism")
    assert want and len(n) > 5


def test_numbers(spark, tmp_path):
    at = f"{tmp_path}/odd name+%.parquet"
    spark.range(1000).withColumn("_file", F.lit(1)).withColumn("_metadata", F.lit(2)).withColumn("rid", F.lit(3)).repartition(7).write.parquet(at)
    df = spark.read.parquet(at)
    one = common.numbered(df.where("id % 2 = 0"), "number")
    assert one.columns == [*df.columns, "number"]
    many = {r.id: r.number for r in common.numbered(df, "number").collect()}
    assert len(set(many.values())) == 1000 and {r.id: r.number for r in one.collect()}.items() <= many.items()
    # rows that are no rows of files are numbered once and kept
    made = common.numbered(df.union(df).select("id").withColumn("x", F.rand()), "number")
    assert rows(made) == rows(made) and made.select("number").distinct().count() == 2000
    assert common.numbered(df.limit(0), "number").count() == 0
