"""JSON documents read by VARIANT, for files whose fields come and go: nothing unknown is lost and nothing malformed is silent.

A document is parsed once, into a binary value whose fields are then taken out by path. Of each field that is asked for:

* a missing or null one gets its default;
* one that cannot be cast to its type gets its default too, and its name is listed in `unfit`;
* all others stay, as JSON by name in `more`.

A top-level array gives a row for each element, in order. Texts that are no JSON, and elements that are no objects, are
rows of malformed() with their place. Null and blank texts are nothing. A byte order mark is dropped. No plan has Python.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    default: Any = None
    path: str | None = None  # $.name, unless given


def documents(texts: DataFrame, text: str = "text") -> DataFrame:
    """The other columns of texts with `ord` (place in the document's array, 0 for a single one), `v` (the value, null if the text is no
    JSON) and `raw` (the text, or the element as JSON)."""
    keys = [c for c in texts.columns if c != text]
    body = F.regexp_replace(F.col(text), "^﻿", "")
    rows = texts.where(F.trim(body) != "").select(*keys, body.alias("_raw"), F.try_parse_json(body).alias("_v"))
    array = F.schema_of_variant("_v").startswith("ARRAY")
    one = rows.where(~F.coalesce(array, F.lit(False))).select(*keys, F.lit(0).alias("ord"), F.col("_v").alias("v"), F.col("_raw").alias("raw"))
    each = rows.where(array).lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("_v").outer())).select(*keys, F.col("pos").alias("ord"), F.col("value").alias("v"), F.to_json("value").alias("raw"))
    return one.union(each)


def _object():
    return F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))


def malformed(texts: DataFrame, text: str = "text") -> DataFrame:
    """What is no object: the columns of texts, ord, raw and why."""
    bad = documents(texts, text).where(~_object())
    return bad.withColumn("why", F.when(F.col("v").isNull(), "no JSON").otherwise(F.concat(F.lit("not an object but "), F.lower(F.schema_of_variant("v"))))).drop("v")


def scan(texts: DataFrame, fields: list[Field], text: str = "text") -> DataFrame:
    """The columns of texts and ord, then the fields, `more` (map of name to JSON) and `unfit` (names)."""
    keys = [c for c in texts.columns if c != text]
    rows = documents(texts, text).where(_object())
    path = lambda f: f.path or f"$.{f.name}"
    value = {f.name: F.try_variant_get("v", path(f), f.type) for f in fields}
    given = {f.name: F.try_variant_get("v", path(f), "variant") for f in fields}
    there = {n: g.isNotNull() & ~F.is_variant_null(g) for n, g in given.items()}
    out = [F.coalesce(value[f.name], F.lit(f.default).cast(f.type)).alias(f.name) if f.default is not None else value[f.name].alias(f.name) for f in fields]
    top = [f.name for f in fields if f.path is None] + [f.path[2:].split(".")[0].split("[")[0] for f in fields if f.path]
    more = F.map_filter(F.col("v").cast("map<string,variant>"), lambda k, _: ~k.isin(top))
    unfit = F.filter(F.array(*[F.when(there[f.name] & value[f.name].isNull(), F.lit(f.name)) for f in fields]), lambda x: x.isNotNull())
    return rows.select(*keys, "ord", *out, F.transform_values(more, lambda _, v: F.to_json(v)).alias("more"), unfit.alias("unfit"))
