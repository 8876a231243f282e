"""Queries over pages and texts: extraction, discovery, redaction, carry-forward."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import vocabulary as V
from ..operators import nodes, parse, progress
from ..operators.resolve import two_pass
from ..sinks import files
from ..sources import discover, fetch
from ..streaming.crawl import frontier
from .registry import query

_LINKS = "SELECT page_id, url AS page_url, unnest(regexp_extract_all(html, '<a href=\"([^\"]+)\"', 1)) AS href FROM pages"
_ABSOLUTE = f"SELECT page_id, CASE WHEN href LIKE 'http%' THEN href ELSE regexp_extract(page_url, '^(https?://[^/]+)', 1) || href END AS link FROM ({_LINKS})"


def _links(t):
    return t("pages").select("page_id", F.explode(parse.anchors_udf("url", "html")).alias("a")).select("page_id", F.col("a.url").alias("link"))


@query(f"SELECT CASE WHEN n IS NULL THEN 'external' ELSE 'exact' END AS resolution, count(*) AS n_links FROM (SELECT DISTINCT link FROM ({_ABSOLUTE})) l LEFT JOIN (SELECT url AS n FROM pages) p ON l.link = p.n GROUP BY 1")
def links_resolution(t, spark):
    known = t("pages").select(F.col("url").alias("full_type_name"), F.lit(None).cast("string").alias("short_name"))
    found = two_pass(_links(t).select("link").distinct(), "link", known, "full_type_name", "short_name")
    return found.groupBy(F.col("resolved_how").alias("resolution")).agg(F.count("*").alias("n_links"))


_TITLE = "coalesce(nullif(trim(regexp_extract(html, '<h1[^>]*>([^<]*)', 1)), ''), trim(regexp_extract(html, '<title>([^<]*)', 1)))"
for _entity, _sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#x27;", "''"), ("&#39;", "''"), ("&amp;", "&")):
    _TITLE = f"replace({_TITLE}, '{_entity}', '{_sign}')"


@query(f"SELECT page_id, {_TITLE} AS title FROM pages")
def pages_title_fallback(t, spark):
    return t("pages").select("page_id", nodes.title_text(F.col("html")).alias("title"))


@query(f"SELECT page_id, link, count(*) AS n FROM ({_ABSOLUTE}) GROUP BY 1, 2")
def pages_anchors(t, spark):
    return _links(t).groupBy("page_id", "link").agg(F.count("*").alias("n"))


@query("SELECT regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, count(*) AS n FROM pages WHERE contains(url, '/en/') GROUP BY 1")
def links_host_scope(t, spark):
    pages = t("pages").withColumn("host", F.try_parse_url("url", F.lit("HOST")))
    return pages.where(discover.in_scope(F.col("url"), F.col("host"), "en")).groupBy("host").agg(F.count("*").alias("n"))


@query("SELECT page_id, sha256(url) AS cache_key FROM pages")
def url_cache_key(t, spark):
    return t("pages").select("page_id", fetch.cache_key(F.col("url")).alias("cache_key"))


_BOTH = "SELECT 0 AS s, page_id AS o, url AS k, 'pages' AS via FROM pages UNION ALL SELECT 1, item_id, (SELECT min(url) FROM pages p WHERE p.page_id = item_id % 25), 'benchmark' FROM benchmark"


def _strategies(t):
    pages = t("pages").select(F.col("page_id").alias("ord"), "url", F.lit("pages").alias("discovered_via"))
    items = t("benchmark").select(F.col("item_id").alias("ord"), (F.col("item_id") % 25).alias("page_id")).join(t("pages").select("page_id", "url"), "page_id")
    return pages, items.select("ord", "url", F.lit("benchmark").alias("discovered_via"))


@query(f"SELECT k AS url, max_by(via, s * 1000000000 + o) AS discovered_via, min(s * 1000000000 + o) AS place FROM ({_BOTH}) WHERE k IS NOT NULL GROUP BY 1")
def discover_merge_last_wins(t, spark):
    return discover.merge(list(_strategies(t))).select("url", "discovered_via", (F.col("ord.s").cast("long") * 1000000000 + F.col("ord.o")).alias("place"))


@query(f"SELECT k AS url, min_by(via, s * 1000000000 + o) AS discovered_via FROM ({_BOTH}) WHERE k IS NOT NULL GROUP BY 1")
def discover_merge_first_wins(t, spark):
    a, b = _strategies(t)
    rows = a.withColumn("s", F.struct(F.lit(0).alias("s"), "ord")).union(b.withColumn("s", F.struct(F.lit(1).alias("s"), "ord")))
    return discover.first_wins(rows, "url", "s").select("url", "discovered_via")


@query(f"SELECT via AS source, count(*) AS n FROM ({_BOTH}) WHERE k IS NOT NULL GROUP BY 1")
def counts_by_source(t, spark):
    a, b = _strategies(t)
    return discover.counts_by_source(a.union(b).withColumn("discovered_via", F.concat("discovered_via", F.lit(":x")))).withColumnRenamed("count", "n")


@query("SELECT doc_id, EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id) AS cached FROM documents d")
def cached_split(t, spark):
    url = F.col("doc_id").cast("string").alias("url")
    cached, missing = fetch.split_cached(t("documents").select("doc_id", url), t("labels").select(fetch.cache_key(F.col("doc_id").cast("string")).alias("key")).distinct())
    return cached.select("doc_id", F.lit(True).alias("cached")).union(missing.select("doc_id", F.lit(False)))


@query("SELECT p_partkey, p_type, p_type = 'TYPE1' OR starts_with(p_type, 'TYPE1.') AS dotted_prefix, starts_with(p_type, 'TYPE1') AS plain_prefix FROM part")
def namespace_prefix_filter(t, spark):
    c, p = F.col("p_type"), "TYPE1"
    return t("part").select("p_partkey", "p_type", ((c == p) | c.startswith(p + ".")).alias("dotted_prefix"), parse.in_namespace(c, p).alias("plain_prefix"))


_PHRASES = "CASE " + " ".join(f"WHEN contains(lower(text), '{p}') THEN '{p}'" for p in [*V.DOC_PHRASES]) + " END"


@query(f"SELECT doc_id, {_PHRASES} AS phrase FROM documents")
def docs_phrase_hint(t, spark):
    return t("documents").select("doc_id", R.phrase(F.col("text")).alias("phrase"))


@query("SELECT doc_id, lang, source, '' AS text, n_chars FROM documents")
def redaction(t, spark):
    none = F.array().cast("array<string>")
    pages = t("documents").select("doc_id", "lang", "source", "n_chars", F.col("text").alias("summary"), F.col("text").alias("remarks"), none.alias("examples"), F.array(F.struct(F.col("text").alias("summary"), F.col("text").alias("remarks"), none.alias("examples"))).alias("members"))
    return files.redact(pages).select("doc_id", "lang", "source", F.concat("summary", "remarks", F.col("members")[0]["summary"]).alias("text"), "n_chars")


@query("SELECT conv_id, turn, role, last_value(CASE WHEN role = 'user' THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS last_user_turn FROM conversations")
def section_carry_forward(t, spark):
    c = t("conversations").withColumn("m", F.when(F.col("role") == "user", F.col("turn")))
    return progress.carried(c, "m", ["conv_id"], "turn", "last_user_turn").select("conv_id", "turn", "role", "last_user_turn")


@query("SELECT conv_id, turn, coalesce(lead(turn) OVER (PARTITION BY conv_id ORDER BY turn), 1000) AS stop FROM conversations")
def region_until_next(t, spark):
    return progress.regions(t("conversations").withColumn("length", F.lit(1000).cast("long")), ["conv_id"], "turn").select("conv_id", "turn", "stop")


@query("WITH RECURSIVE w(conv_id, turn, place, depth) AS (SELECT conv_id, turn, turn, 0 FROM conversations UNION ALL SELECT w.conv_id, w.turn, w.place - 1, w.depth + 1 FROM w WHERE w.place > 0) SELECT conv_id, turn, max(depth) AS n_ancestors FROM w GROUP BY 1, 2")
def chain_walk(t, spark):
    from ..operators.classify import chains

    name = lambda turn: F.concat(F.lit("c"), "conv_id", F.lit("_"), turn.cast("string"))
    c = t("conversations")
    pages = c.select("conv_id", "turn", F.xxhash64("conv_id", "turn").alias("ord"), name(F.col("turn")).alias("full_type_name"), F.lit("class").alias("kind"), F.when(F.col("turn") > 0, name(F.col("turn") - 1)).alias("base_type"))
    return pages.join(chains(pages), "full_type_name").select("conv_id", "turn", F.size("chain").cast("long").alias("n_ancestors"))


_EDGES = f"SELECT DISTINCT p.url AS u, a.link AS v FROM pages p JOIN ({_ABSOLUTE}) a ON a.page_id = p.page_id"


@query(f"WITH RECURSIVE e AS ({_EDGES}), r(url) AS (SELECT url FROM pages WHERE contains(url, '/en/') UNION SELECT e.v FROM r JOIN e ON e.u = r.url) SELECT url FROM r")
def frontier_fixpoint(t, spark):
    links = t("pages").select("url", F.explode(parse.anchors_udf("url", "html")).alias("a")).select("url", F.col("a.url").alias("to"))
    return frontier(t("pages").where(F.contains("url", F.lit("/en/"))).select("url"), links).select("url")


@query("SELECT user_id, max_by(event_type, event_id) AS hint FROM events e WHERE event_id < coalesce((SELECT min(event_id) FROM events v WHERE v.user_id = e.user_id AND v.event_type = 'purchase'), 9000000000000) GROUP BY 1")
def late_hint_correction(t, spark):
    from ..streaming.crawl import corrected_hints

    e = t("events").select(F.col("user_id").cast("string").alias("url"), F.col("event_type").alias("hint"), F.col("event_id").alias("seq"))
    visits = e.where("hint = 'purchase'").groupBy("url").agg(F.min("seq").alias("seq"))
    return corrected_hints(e, visits).select(F.col("url").cast("long").alias("user_id"), "hint")


@query("SELECT event_id, coalesce(lag(event_id, 6) OVER (PARTITION BY user_id ORDER BY event_id), 0) AS back FROM events")
def rate_lag6(t, spark):
    log = t("events").select("user_id", F.col("event_id"), (F.col("event_id") + 1).cast("double").alias("elapsed"), (F.col("event_id") + 1).alias("pages"))
    r = progress.rates(log.withColumn("pages", F.col("pages") * 2), ["user_id"], "event_id")
    # with 2 pages in each second the trailing rate is 2, whatever sample it looks back to; the sample itself is asked for
    w = Window.partitionBy("user_id").orderBy("event_id")
    return r.where("trailing_rate = 2.0").withColumn("back", F.coalesce(F.lag("event_id", 6).over(w), F.lit(0))).select("event_id", "back")


@query("SELECT event_id, CAST(floor(avg(event_id % 100) OVER (PARTITION BY event_type ORDER BY event_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) * 1000 + 0.0001) AS BIGINT) AS mean_milli FROM events")
def trailing_avg50(t, spark):
    r = progress.trailing_mean(t("events").withColumn("v", F.col("event_id") % 100), "v", ["event_type"], "event_id")
    return r.select("event_id", F.floor(F.col("trailing_mean") * 1000 + 0.0001).alias("mean_milli"))


@query("SELECT n_nationkey, CASE WHEN s >= 3600 THEN printf('%dh%02dm', s // 3600, s % 3600 // 60) WHEN s >= 60 THEN printf('%dm%02ds', s // 60, s % 60) ELSE printf('%ds', s) END AS took FROM (SELECT n_nationkey, CAST(n_nationkey * 397 AS BIGINT) AS s FROM nation)")
def duration_text(t, spark):
    return t("nation").select("n_nationkey", R.duration((F.col("n_nationkey") * 397).cast("double")).alias("took"))
