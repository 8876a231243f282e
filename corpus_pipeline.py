"""A training-data pipeline over `documents`: each stage calls one operator of docgraph.llm on what the one before kept.

toxicity             documents that score as toxic go
ngram_join           of each group of near-duplicates the document of smallest doc_id stays; rows are told apart by their
                     place, so texts that share a doc_id, or have none, are documents of their own
decontamination      documents that hold a test item go
pii                  personal data in texts is replaced by marks; n_chars follows
sentencepiece        the texts' ids, their number and whether they decode to the text

All stages but the last return the columns of `documents`, and further ones of any name that the table has. A repeated
row is a near-duplicate of itself: one stays. Of ties in doc_id the first row stays. Null and empty texts pass every
stage, very long ones are read whole, and an empty table gives no rows.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.llm import common, decontaminate, ngram_join, pieces, pii, toxicity


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = common.table(spark, sf_dir, "labels")
    scorer = toxicity.learn(docs.where(~common.held_out()), labels.where(~common.held_out()))
    return toxicity.clean(docs, scorer)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.first_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"))


def mark_personal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kind = docs.schema["n_chars"].dataType
    return pii.redacted(docs).withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs, pieces.read_model(spark), cache=100_000)  # executors still hold what earlier stages left


STAGES = [("toxicity", drop_toxic), ("ngram_join", one_of_each_group), ("decontamination", drop_leaks), ("pii", mark_personal), ("sentencepiece", encode)]
#: The stages are not expressible in SQL; tests/llm hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = common.cut(docs, f"pipeline-{name}")
    return docs
