"""Sinks: tables as JSON, CSV and Parquet, redaction, enum catalog, edges by kind."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import renamed


def json_table(df: DataFrame, path: str, order: str | None = "ord") -> None:
    """One JSON document a row, under the files' field names, in part files."""
    if order and order in df.columns:
        df = df.orderBy(order).drop(order)
    renamed(df, outward=True).write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def json_array(df: DataFrame, order: str | None = "ord") -> str:
    """The rows as one indented JSON array. For reports and other small results: it is made on the driver."""
    import json

    df = df.orderBy(order).drop(order) if order and order in df.columns else df
    rows = [json.loads(r[0]) for r in renamed(df, outward=True).select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"})).toLocalIterator()]
    return json.dumps(rows, indent=2, ensure_ascii=False)


def redact(pages: DataFrame) -> DataFrame:
    """api_pages with all prose of pages and members blank."""
    blank, none = F.lit(""), F.array().cast("array<string>")
    members = F.transform("members", lambda m: m.withField("summary", blank).withField("remarks", blank).withField("examples", none))
    return pages.withColumn("summary", blank).withColumn("remarks", blank).withColumn("examples", none).withColumn("members", members)


def api_pages(pages: DataFrame, path: str, with_text: bool = False) -> None:
    json_table(pages if with_text else redact(pages), path)


def edges_by_kind(edges: DataFrame, path: str) -> None:
    """Edges in a folder for each member kind; read together they are the union."""
    edges.withColumn("kind_of_member", F.col("member_kind")).write.mode("overwrite").partitionBy("kind_of_member").parquet(path)


def enum_catalog(pages: DataFrame) -> DataFrame:
    """Members of each enum by short name, in page order; pages without members give none."""
    rows = pages.where("kind = 'enum'").select("ord", "type_name", F.posexplode("enum_members").alias("at", "m"))
    listed = F.array_sort(F.collect_list(F.struct("ord", "at", "m")))
    return rows.groupBy("type_name").agg(F.transform(listed, lambda x: x["m"]).alias("members"))


def csv_table(df: DataFrame, path: str) -> None:
    flat = [F.array_join(c, "; ").alias(c) if t.startswith("array<string") else F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes]
    df.select(*flat).write.mode("overwrite").option("header", True).csv(path)
