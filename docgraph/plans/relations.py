"""Queries over pages as relations of tags and texts, whose plans have no Python, and over forests with intervals."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ancestry, copartitioned, corroborate, incremental, nodes
from ..operators.lineage import cut, scratch
from ..sources import page_files, tolerant
from . import registry, typed
from .pages import _ABSOLUTE, _TITLE
from .registry import query


def _nodes(t):
    return nodes.nodes(t("pages").select("page_id", "url", "html"), "page_id")


@query(f"SELECT page_id, {_TITLE} AS title FROM pages")
def node_titles(t, spark):
    pages = t("pages").select("page_id")
    return pages.join(nodes.titles(_nodes(t), "page_id"), "page_id", "left").select("page_id", F.coalesce("title", F.lit("")).alias("title"))


@query(f"SELECT page_id, link, count(*) AS n FROM ({_ABSOLUTE}) GROUP BY 1, 2")
def node_anchors(t, spark):
    return nodes.anchors(_nodes(t), "url").groupBy("page_id", "link").agg(F.count("*").alias("n"))


@query("SELECT page_id, regexp_extract(html, '<nav><ul><li><a href=\"([^\"]*)\"', 1) AS href, trim(regexp_extract(html, '<nav><ul><li><a href=\"[^\"]*\">([^<]*)', 1)) AS text FROM pages WHERE contains(html, '<nav><ul><li><a href=')")
def node_first_of_type(t, spark):
    """The selector nav > ul > li:first-of-type > a."""
    n = _nodes(t)
    items = nodes.first_of_type(nodes.within(nodes.elements(n, "li"), nodes.within(nodes.elements(n, "ul"), nodes.elements(n, "nav"), "page_id", True), "page_id", True), n, "page_id")
    found = nodes.within(nodes.elements(n, "a"), items, "page_id", True)
    return nodes.texts(found, n, "page_id").select("page_id", nodes.attribute(F.col("token"), "href").alias("href"), "text")


@query("SELECT page_id, (length(html) - length(replace(html, '<br>', ''))) // 4 AS breaks, len(regexp_extract_all(regexp_extract(html, '<article>(.*)</article>', 1, 's'), '<p>'))::BIGINT AS paragraphs, (length(html) - length(replace(html, '</li>', ''))) // 5 AS items FROM pages")
def node_sections(t, spark):
    """Breaks below the main heading, paragraphs within the article and items within the navigation."""
    n = _nodes(t)
    count = lambda rows, name: rows.groupBy("page_id").agg(F.count("*").alias(name))
    breaks = count(nodes.sections(nodes.elements(n, "br", "h1"), "page_id").where("name = 'br' and heading.name = 'h1'"), "breaks")
    paragraphs = count(nodes.within(nodes.elements(n, "p"), nodes.elements(n, "article"), "page_id"), "paragraphs")
    items = count(nodes.within(nodes.elements(n, "li"), nodes.elements(n, "nav"), "page_id"), "items")
    out = t("pages").select("page_id")
    for part in (breaks, paragraphs, items):
        out = out.join(part, "page_id", "left")
    return out.select("page_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("breaks", "paragraphs", "items")])


def _tree(t):
    """Turns of a conversation as a tree: turn n answers turn (n - 1) // 2."""
    name = lambda turn: F.concat_ws("/", F.col("conv_id").cast("string"), turn.cast("string"))
    c = t("conversations")
    parents = c.select(name(F.col("turn")).alias("id"), F.when(F.col("turn") > 0, name(F.floor((F.col("turn") - 1) / 2))).alias("parent"))
    return c.withColumn("id", name(F.col("turn"))).join(ancestry.tour(parents), "id")


_UP = "WITH RECURSIVE w(conv_id, turn, up) AS (SELECT conv_id, turn, turn FROM conversations UNION ALL SELECT conv_id, turn, (up - 1) // 2 FROM w WHERE up > 0)"


@query(f"{_UP} SELECT conv_id, turn, count(*) - 1 AS depth, max(up) FILTER (up IN (SELECT c.turn FROM conversations c WHERE c.conv_id = w.conv_id AND c.role = 'user')) AS nearest FROM w GROUP BY 1, 2")
def ancestor_nearest(t, spark):
    """Of each turn its depth, and the nearest turn at or above it that a user has said."""
    tree = cut(_tree(t).select("conv_id", "turn", "role", "root", "pre", "post", "depth"))
    users = tree.where("role = 'user'").select("root", "pre", "post", "turn")
    found = ancestry.nearest(tree.select("conv_id", "depth", F.col("turn").alias("of"), "root", "pre"), users, [], ["turn"])
    return found.select("conv_id", F.col("of").alias("turn"), "depth", F.col("found.turn").alias("nearest"))


_SEEN = "max(turn) FILTER (role = 'user'{}) OVER (PARTITION BY conv_id ORDER BY turn)"


@query(f"SELECT conv_id, turn, CASE WHEN a IS NOT NULL THEN 'signature_confirmed' WHEN b IS NOT NULL THEN 'signature_mismatch' ELSE 'member_not_found' END AS status, CASE WHEN coalesce(a, b) = turn THEN 'declared' WHEN coalesce(a, b) IS NOT NULL THEN 'inherited' END AS scope, 'R' || coalesce(a, b) % 3 AS actual FROM (SELECT *, {_SEEN.format(' AND turn % 3 = 0')} AS a, {_SEEN.format('')} AS b FROM conversations)")
def manifest_members_on_chains(t, spark):
    """Turns as types that inherit from all turns before them; those of users have a member. Each one is asked for it."""
    c = t("conversations")
    name = lambda turn: F.concat(F.lit("C"), F.col("conv_id").cast("string"), F.lit(".T"), turn.cast("string"))
    member = F.struct(F.lit("Ask").alias("name"), F.lit("property").alias("kind"), F.lit(None).cast("string").alias("declaring_type"), F.concat(F.lit("R"), (F.col("turn") % 3).cast("string")).alias("return_type"), F.array().cast("array<struct<name:string,type:string>>").alias("parameters"))
    above = F.when(F.col("turn") > 0, F.transform(F.sequence(F.col("turn") - 1, F.lit(0), F.lit(-1)), name)).otherwise(F.array().cast("array<string>"))
    types = c.select(name(F.col("turn")).alias("full_type_name"), name(F.col("turn")).alias("short"), above.alias("inheritance_chain"), F.when(F.col("role") == "user", F.array(member)).otherwise(F.array().cast("array<struct<name:string,kind:string,declaring_type:string,return_type:string,parameters:array<struct<name:string,type:string>>>>")).alias("members"))
    edges = c.select("conv_id", "turn", F.xxhash64("conv_id", "turn").alias("ord"), name(F.col("turn")).alias("source_type"), F.lit("Ask").alias("member_name"), F.lit("property").alias("member_kind"), F.lit("R0").alias("return_type"), F.array().cast("array<string>").alias("parameter_types"))
    return corroborate.edge_results(edges, types).select("conv_id", "turn", F.col("dll_verified_status").alias("status"), F.col("dll_relationship_scope").alias("scope"), F.col("actual_return_type").alias("actual"))


_KNOWN = "SELECT 'N' || p_size % 3 || '.P' || p_partkey % 700 AS f, 'P' || p_partkey % 700 AS s FROM part"
_NAMED = "SELECT 'S' || l_suppkey AS source, CASE WHEN l_partkey % 3 = 0 THEN 'N1.P' ELSE 'Q.P' END || l_partkey % 700 AS q FROM lineitem"


@query(f"WITH k AS ({_KNOWN}), one AS (SELECT s, min(f) AS f FROM k GROUP BY s HAVING count(*) = 1) SELECT source, coalesce(e.f, o.f, q) AS target, CASE WHEN e.f IS NOT NULL THEN 'exact' WHEN o.f IS NOT NULL THEN 'short_name_fallback' ELSE 'external' END AS how, count(*) AS n FROM ({_NAMED}) x LEFT JOIN (SELECT DISTINCT f FROM k) e ON e.f = q LEFT JOIN one o ON o.s = regexp_extract(q, '[^.]*$') GROUP BY 1, 2, 3")
def incremental_resolution(t, spark):
    """Parts as nodes and order lines as edges arrive in four batches; short names become known, and then ambiguous."""
    kept = incremental.Maintained(spark, scratch(spark, "incremental"), 16)
    p, l = t("part"), t("lineitem")  # noqa: E741
    short = F.concat(F.lit("P"), (F.col("p_partkey") % 700).cast("string"))
    nodes_ = p.select("p_partkey", F.concat(F.lit("N"), (F.col("p_size") % 3).cast("string"), F.lit("."), short).alias("full"), short.alias("short"), F.lit(1).cast("long").alias("n"))
    target = F.concat(F.when(F.col("l_partkey") % 3 == 0, "N1.P").otherwise("Q.P"), (F.col("l_partkey") % 700).cast("string"))
    edges = l.select("l_orderkey", F.concat(F.lit("S"), "l_suppkey").alias("source"), target.alias("target"), F.lit("core").alias("tier"), F.lit(1).cast("long").alias("n"))
    for k in range(4):
        kept.apply(nodes_.where(F.floor(F.col("p_partkey") / 700) % 4 == k).drop("p_partkey"), edges.where(F.col("l_orderkey") % 4 == k).drop("l_orderkey"), k)
    return kept.result().select("source", "target", "how", "n")


_TWO = f"WITH k AS ({_KNOWN}), one AS (SELECT s, min(f) AS f FROM k GROUP BY s HAVING count(*) = 1) SELECT l_orderkey, l_linenumber, coalesce(e.f, o.f) AS resolved, CASE WHEN e.f IS NOT NULL THEN 'exact' WHEN o.f IS NOT NULL THEN 'short_name_fallback' ELSE 'external' END AS how FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 3 = 0 THEN 'N1.P1' WHEN l_partkey % 3 = 1 THEN 'N1.P' || l_partkey % 700 ELSE 'Q.P' || l_partkey % 700 END AS q FROM lineitem) x LEFT JOIN (SELECT DISTINCT f FROM k) e ON e.f = q LEFT JOIN one o ON o.s = regexp_extract(q, '[^.]*$')"


@query(_TWO)
def stored_resolution(t, spark):
    """Order lines in buckets by the name they ask for, a third of them for one; names are looked up, lines stay."""
    p, l = t("part"), t("lineitem")  # noqa: E741
    short = F.concat(F.lit("P"), (F.col("p_partkey") % 700).cast("string"))
    known = p.select(F.concat(F.lit("N"), (F.col("p_size") % 3).cast("string"), F.lit("."), short).alias("full"), short.alias("short"))
    k, rest = F.col("l_partkey") % 3, (F.col("l_partkey") % 700).cast("string")
    name = F.when(k == 0, "N1.P1").when(k == 1, F.concat(F.lit("N1.P"), rest)).otherwise(F.concat(F.lit("Q.P"), rest))
    lines = l.select("l_orderkey", "l_linenumber", F.xxhash64("l_orderkey", "l_linenumber").alias("ord"), name.alias("q"))
    stored = copartitioned.by_name(lines, "q", buckets=16)
    return copartitioned.resolved(stored, "q", known, "full", "short").select("l_orderkey", "l_linenumber", "resolved", F.col("resolved_how").alias("how"))


@query(registry.SQL["overload_match"])
def stored_overloads(t, spark):
    """overload_match over orders in buckets by what they ask of the manifest."""
    edges, types = typed._overloads(t)
    return copartitioned.edge_results(copartitioned.by_question(edges, buckets=16), types).select("o_orderkey", F.col("dll_verified_status").alias("status"), F.col("dll_relationship_scope").alias("scope"))


@query("SELECT url, regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host, length(html) AS n_chars FROM pages WHERE starts_with(url, (SELECT regexp_extract(min(url), '^https?://[^/?#:]+', 0) FROM pages))")
def pages_by_prefix(t, spark):
    """The pages of one site, served from files by host of which the others are not opened."""
    at = scratch(spark, "page-files")
    page_files.write_pages(t("pages"), at)
    site = t("pages").agg(F.regexp_extract(F.min("url"), "^https?://[^/?#:]+", 0)).first()[0]
    return page_files.load(spark, at).where(F.col("url").startswith(site)).select("url", "host", F.length("html").cast("long").alias("n_chars"))


def _event_texts(t):
    """Events as JSON texts: some cut off, some without a field, with one more, or with one of another type."""
    k = F.col("event_id")
    number = F.when(k % 5 == 0, F.lit("")).when(k % 11 == 0, F.lit('"value": "many", ')).otherwise(F.concat(F.lit('"value": '), F.col("user_id").cast("string"), F.lit(", ")))
    more = F.when(k % 3 == 0, F.concat(F.lit(', "colour": {"k": '), (k % 9).cast("string"), F.lit("}"))).otherwise("")
    whole = F.concat(F.lit("{"), number, F.lit('"type": "'), F.col("event_type"), F.lit('"'), more, F.lit("}"))
    return t("events").select("event_id", F.when(k % 7 == 0, F.substring(whole, 1, 9)).when(k % 13 == 0, F.concat(F.lit("["), whole, F.lit(", 1]"))).otherwise(whole).alias("text"))


@query("SELECT event_id, 0 AS ord, CASE WHEN event_id % 5 = 0 OR event_id % 11 = 0 THEN -1 ELSE user_id END AS value, event_type AS type, CASE WHEN event_id % 3 = 0 THEN '{\"k\":' || event_id % 9 || '}' END AS colour, event_id % 11 = 0 AND event_id % 5 <> 0 AS unfit FROM events WHERE event_id % 7 <> 0")
def tolerant_scan(t, spark):
    fields = [tolerant.Field("value", "bigint", -1), tolerant.Field("type", "string")]
    return tolerant.scan(_event_texts(t), fields).select("event_id", "ord", "value", "type", F.col("more")["colour"].alias("colour"), (F.size("unfit") > 0).alias("unfit"))


@query("SELECT event_id, 0 AS ord, 'no JSON' AS why FROM events WHERE event_id % 7 = 0 UNION ALL SELECT event_id, 1, 'not an object but bigint' FROM events WHERE event_id % 7 <> 0 AND event_id % 13 = 0")
def tolerant_malformed(t, spark):
    return tolerant.malformed(_event_texts(t)).select("event_id", "ord", "why")
