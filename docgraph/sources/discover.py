"""Discovery of page URLs: TOC trees, anchors, TOC files, sitemaps; merged with explicit order rules."""

from __future__ import annotations

import json
import re
from urllib.parse import urljoin
from xml.etree import ElementTree

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import vocabulary as V
from ..operators.parse import anchors, udf

TOC = "struct<ord:int,url:string,link_text:string,tag:string,namespace:string,full_name:string,declaring_type_hint:string>"
KIND_WORDS = ("Class", "Structure", "Struct", "Enumeration", "Enum", "Interface")


def toc_rows(text: str | None, root: str | None, prefix: str | None, wanted: list[str] | None = None) -> list[dict]:
    """The pages of a TOC tree under the namespaces of a prefix (itself or a dotted sub-namespace), in tree order.

    A type's node gives its full name as the hint of all nodes below. With `wanted` full names only their subtrees are
    kept, and the walk does not look for further types within one. Malformed JSON has no pages.
    """
    try:
        tree = json.loads(text or "")
    except ValueError:
        return []
    out: list[dict] = []

    def name(title: str, words=("Namespace",)) -> str:
        return next((title[: -len(w) - 1] for w in words if title.endswith(" " + w)), title)

    def walk(node: dict, space: str, hint: str | None, take: bool) -> None:
        title, full = node.get("title") or "", None
        if (node.get("tag") or "") in ("Class", "Struct", "Structure", "Interface", "Enum", "Enumeration"):
            full = hint = f"{space}.{name(title, KIND_WORDS)}"
            take = take or (wanted is not None and full in wanted)
        if take and node.get("href"):
            out.append({"ord": len(out), "url": urljoin(root or "", node["href"]), "link_text": title, "tag": node.get("tag"), "namespace": space, "full_name": full, "declaring_type_hint": hint})
        for child in node.get("children") or []:
            walk(child, space, hint, take)

    for top in tree if isinstance(tree, list) else [tree]:
        for child in top.get("children") or []:
            space = name(child.get("title") or "")
            if not prefix or space == prefix or space.startswith(prefix + "."):
                for below in child.get("children") or []:
                    walk(below, space, None, wanted is None)
    return out


def from_toc(tocs: DataFrame, root: str, prefix: str = V.DB_NAMESPACE, wanted: list[str] | None = None) -> DataFrame:
    """Entries of TOC files (text); the first of equal URLs counts."""
    rows = tocs.select(F.explode(udf(lambda t: toc_rows(t, root, prefix, wanted), f"array<{TOC}>")("text")).alias("x")).select("x.*")
    return first_wins(rows, "url", "ord").withColumn("discovered_via", F.concat(F.lit("namespace_json:"), F.coalesce("tag", F.lit(""))))


def found_targets(wanted: DataFrame, entries: DataFrame) -> DataFrame:
    """wanted (full_type_name) with whether a type page of the name was discovered."""
    have = entries.where("full_name is not null").select(F.col("full_name").alias("full_type_name")).distinct().withColumn("f", F.lit(True))
    return wanted.join(have, "full_type_name", "left").select("full_type_name", F.coalesce("f", F.lit(False)).alias("found"))


def in_scope(url, host: str, version: str):
    """Whether a URL is on the host and under the version's path."""
    return (F.try_parse_url(url, F.lit("HOST")) == host) & F.contains(url, F.lit(f"/{version}/"))


def page_ids(text: str | None, base: str, version: str) -> list[str]:
    """Page paths that stand as string literals in scripts and TOC files."""
    return [urljoin(base, m) for m in re.findall(rf"[\"'](/?{re.escape(version)}/[0-9a-fA-F-]{{8,}}\.htm)[\"']", text or "")]


def from_html(pages: DataFrame, via: str, host: str, version: str, base: str) -> DataFrame:
    """Entries of pages (url, html): anchors, the last of equal URLs in the first one's place, then page ids not yet seen."""
    a = pages.select(F.posexplode(udf(anchors, "array<struct<url:string,link_text:string>>")("url", "html")).alias("ord", "x")).select("ord", "x.*").where(in_scope(F.col("url"), host, version))
    a = last_wins(a, "url", "ord").withColumn("discovered_via", F.lit(via))
    ids = pages.select(F.posexplode(udf(lambda t: page_ids(t, base, version), "array<string>")("html")).alias("ord", "url"))
    ids = first_wins(ids, "url", "ord").join(a.select("url"), "url", "left_anti")
    return a.unionByName(ids.select("ord", "url", F.lit("").alias("link_text"), F.lit(f"{via}:regex_guid").alias("discovered_via")).withColumn("ord", F.col("ord") + (1 << 20)))


def sitemap_urls(text: str | None, source: str | None) -> list[str]:
    """<loc> texts of any XML namespace; none if the XML is malformed."""
    try:
        root = ElementTree.fromstring(text or "")
    except ElementTree.ParseError:
        return []
    return [urljoin(source or "", e.text.strip()) for e in root.iter() if e.tag.rsplit("}", 1)[-1] == "loc" and e.text]


def from_sitemap(maps: DataFrame, host: str, version: str) -> DataFrame:
    rows = maps.select(F.posexplode(udf(sitemap_urls, "array<string>")("text", "url")).alias("ord", "url")).where(in_scope(F.col("url"), host, version))
    return last_wins(rows, "url", "ord").select("ord", "url", F.lit("").alias("link_text"), F.lit("sitemap_xml").alias("discovered_via"))


def first_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_n = 1").drop("_n")


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key, in the place of its first."""
    w = Window.partitionBy(key)
    out = rows.withColumn("_last", F.max(order).over(w)).withColumn("_first", F.min(order).over(w)).where(F.col(order) == F.col("_last"))
    return out.withColumn(order, F.col("_first")).drop("_first", "_last")


def merge(strategies: list[DataFrame], most: int | None = None) -> DataFrame:
    """All strategies' entries: a later strategy replaces an entry (its hint too), in the place of the first."""
    all_ = None
    for k, rows in enumerate(strategies):
        rows = rows.withColumn("ord", F.struct(F.lit(k).alias("s"), F.col("ord").alias("o")))
        all_ = rows if all_ is None else all_.unionByName(rows, allowMissingColumns=True)
    out = last_wins(all_, "url", "ord").orderBy("ord")
    return out.limit(most) if most is not None else out


def counts_by_source(entries: DataFrame) -> DataFrame:
    return entries.groupBy(F.split("discovered_via", ":")[0].alias("source")).count()


def safely(strategies: dict) -> tuple[list[DataFrame], list[str]]:
    """Runs each strategy (name -> function) on its own; (results, errors)."""
    done, errors = [], []
    for name, f in strategies.items():
        try:
            done.append(f())
        except Exception as e:
            errors.append(f"{name}: {e!r}")
    return done, errors


def texts(spark: SparkSession, path: str) -> DataFrame:
    """Files as (url, text): each file whole."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("url"), F.col("value").alias("text"))
