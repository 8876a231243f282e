"""Candidate files, the compiled manifest, and the listing of assemblies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import vocabulary as V


def _json(spark: SparkSession, path: str, schema: str, array: bool) -> DataFrame:
    """A JSON file with one document, read by schema; a byte order mark is dropped, missing fields are null."""
    text = spark.read.text(path, wholetext=True).select(F.regexp_replace("value", "^\uFEFF", "").alias("j"))
    struct = T._parse_datatype_string(f"struct<{_ddl(schema)}>")
    if array:
        rows = text.select(F.posexplode(F.from_json("j", T.ArrayType(struct))).alias("ord", "r"))
        return rows.select("ord", "r.*")
    return text.select(F.from_json("j", struct).alias("r")).select("r.*")


def _ddl(schema: str) -> str:
    return T._parse_datatype_string(schema).simpleString()[7:-1]


def renamed(df: DataFrame, outward: bool = False) -> DataFrame:
    """Columns under our names, or (outward) under those of the JSON files."""
    for ours, theirs in V.FIELDS.items():
        df = df.withColumnRenamed(*((ours, theirs) if outward else (theirs, ours)))
    return df


def _outward(schema: str) -> str:
    for ours, theirs in V.FIELDS.items():
        schema = ", ".join(theirs + c[len(ours) :] if c.startswith(ours + " ") else c for c in schema.split(", "))
    return schema


def nodes(spark: SparkSession, path: str) -> DataFrame:
    return _json(spark, path, schemas.NODES, True)


def edges(spark: SparkSession, path: str) -> DataFrame:
    return renamed(_json(spark, path, _outward(schemas.EDGES), True))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    return renamed(_json(spark, path, schemas.MANIFEST, False))


def reference(spark: SparkSession, path: str) -> DataFrame:
    return renamed(_json(spark, path, schemas.REFERENCE, False))


def assemblies(files: DataFrame) -> DataFrame:
    """One file for each assembly name and major version: the first by path. files: path, name, version."""
    w = Window.partitionBy(F.lower("name"), F.split("version", r"\.")[0]).orderBy("path")
    return files.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """(what, value, n): totals, types by kind, unresolved sentinels, by-reference parameters, methods without result."""
    t = manifest.select(F.explode("types").alias("t")).select("t.*")
    m = t.select("full_type_name", F.explode("members").alias("m")).select("full_type_name", "m.*")
    p = m.select(F.explode("parameters").alias("p")).select("p.*")
    one = lambda df, what, value: df.select(F.lit(what).alias("what"), value.alias("value"))
    rows = one(t, "kind", F.col("kind"))
    rows = rows.union(one(t, "total", F.lit("types"))).union(one(m, "total", F.lit("members")))
    rows = rows.union(one(m.where("return_type = '<unresolved>'"), "unresolved", F.lit("return_type")))
    for c, kind in t.dtypes:
        if c in ("base_type", "inheritance_chain", "implemented_interfaces"):
            open_ = F.array_contains(c, "<unresolved>") if kind.startswith("array") else F.col(c) == "<unresolved>"
            rows = rows.union(one(t.where(open_), "unresolved", F.lit(c)))
    rows = rows.union(one(p.where(F.col("type").rlike("^(out|ref) ")), "by_reference", F.substring_index("type", " ", 1)))
    rows = rows.union(one(m.where("kind = 'method' and return_type is null"), "void", F.lit("methods")))
    return rows.groupBy("what", "value").agg(F.count("*").alias("n")).orderBy("what", F.desc("n"), "value")


def by_reference(manifest: DataFrame, most: int = 5) -> DataFrame:
    """The first kinds of parameters that are passed by reference, with a member that has one."""
    t = manifest.select(F.explode("types").alias("t")).select("t.full_type_name", F.explode("t.members").alias("m"))
    p = t.select("full_type_name", F.col("m.name").alias("member_name"), F.explode("m.parameters").alias("p")).where(F.col("p.type").rlike("^(out|ref) "))
    return p.groupBy(F.col("p.type").alias("type")).agg(F.min(F.concat_ws(".", "full_type_name", "member_name")).alias("member")).orderBy("type").limit(most)


def tracked(manifest: DataFrame, facts: list[tuple[str, str]]) -> DataFrame:
    """Of each (type, member) asked for: whether the type is there, its chain, and the member's overloads with their signatures."""
    asked = manifest.sparkSession.createDataFrame([(k, *f) for k, f in enumerate(facts)], "place int, full_type_name string, member_name string")
    t = manifest.select(F.explode("types").alias("t")).select("t.full_type_name", "t.inheritance_chain", "t.members", F.lit(True).alias("there"))
    own = F.filter(F.coalesce("members", F.expr("array()")), lambda m: m["name"] == F.col("member_name"))
    said = F.transform(own, lambda m: F.concat(F.when(m["is_static"], "static ").otherwise(""), F.coalesce(m["return_type"], F.lit("void")), F.lit(" ("), F.array_join(F.transform(m["parameters"], lambda p: p["type"]), ", "), F.lit(")")))
    return asked.join(t, "full_type_name", "left").select("place", "full_type_name", "member_name", F.coalesce("there", F.lit(False)).alias("type_found"), F.array_join("inheritance_chain", " -> ").alias("chain"), F.size(own).alias("overloads"), F.array_join(said, "; ").alias("signatures"))
