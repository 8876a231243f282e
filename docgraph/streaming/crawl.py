"""The crawl as an incremental dataflow: a frontier in rounds, and a stream over a folder of cached pages."""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify, graph, parse
from ..operators.lineage import cut
from ..sources.discover import first_wins


def frontier(seeds: DataFrame, links: DataFrame, most: int | None = None) -> DataFrame:
    """(url, round) of all pages reachable from seeds (url) by links (url, to), breadth first.

    Each round is one join with what is not visited yet; rounds end at the fixpoint or when `most` pages are visited. Every
    round is cut, and what is visited each 8 rounds, so that plans do not grow with the depth.
    """
    visited = cut(seeds.select("url").distinct().withColumn("round", F.lit(0)))
    now, n = visited, visited.count()
    for k in itertools.count(1):
        if most is not None and n >= most:
            break
        new = now.join(links, "url").select(F.col("to").alias("url")).distinct().join(visited.select("url"), "url", "left_anti").withColumn("round", F.lit(k))
        new = cut(new)
        if not (grown := new.count()):
            break
        visited, now, n = visited.union(new), new, n + grown
        visited = cut(visited) if k % 8 == 0 else visited
    return visited.orderBy("round", "url").limit(most) if most is not None else visited


def dispatch(pages: DataFrame) -> dict[str, DataFrame]:
    """Parsed pages by what is done with them; other kinds failed."""
    kinds = {"type": ["class", "struct", "interface"], "enum": ["enum"], "index": ["members_index"], "member": ["property", "method", "constructor"]}
    known = [k for ks in kinds.values() for k in ks]
    return {name: pages.where(F.col("kind").isin(ks)) for name, ks in kinds.items()} | {"failed": pages.where(~F.col("kind").isin(known))}


def corrected_hints(hints: DataFrame, visited: DataFrame) -> DataFrame:
    """The last hint of each url that came before its visit; later ones are too late. hints: url, hint, seq; visited: url, seq."""
    v = visited.select("url", F.col("seq").alias("visit"))
    return hints.join(v, "url", "left").where("visit is null or seq < visit").groupBy("url").agg(F.max_by("hint", "seq").alias("hint"))


def outputs(pages: DataFrame) -> dict[str, DataFrame]:
    """All tables of a set of parsed pages."""
    nodes, edges = classify.nodes(pages), classify.edges(pages)
    g = graph.build(nodes, edges)
    return {"nodes": nodes, "edges": edges, "graph_nodes": g.nodes, "graph_edges": g.edges}


def stream(spark: SparkSession, folder: str, checkpoint: str, write: Callable[[dict[str, DataFrame], bool], None], table: str, every: str = "30 seconds", once: bool = True):
    """Parses arriving Parquet files of pages (url, html, version, hint) and rewrites the outputs.

    Pages are kept as a table, of which the first page of each url counts, so that the stream needs no state that grows;
    each batch appends and recomputes (that is what a checkpoint of the crawl is). The sink is idempotent: a batch that is
    repeated after a failure replaces its own part. On the end of the stream, also by an error, write() is called once
    more with final=True.
    """
    arriving = spark.readStream.schema("ord long, url string, html string, version string, hint string").parquet(folder)

    def batch(rows: DataFrame, epoch: int) -> None:
        parse.parse(first_wins(rows, "url", "ord"), F.col("hint")).write.mode("overwrite").parquet(f"{table}/epoch={epoch}")
        write(outputs(read()), False)

    def read() -> DataFrame:
        return first_wins(spark.read.parquet(table).drop("epoch"), "source_url", "ord")

    query = arriving.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(**({"availableNow": True} if once else {"processingTime": every})).start()
    try:
        query.awaitTermination()
    finally:
        write(outputs(read()), True)
    return query


def _cached(fetcher, url: str) -> bool:
    return bool(getattr(fetcher, "is_cached", lambda _: False)(url))


def fetch_all(fetcher, entries: list[dict], version: str, write: Callable[[list[tuple], bool], None], most: int | None = None, every: int = 25, gap: float = 30.0, say: Callable[[dict], None] | None = None) -> dict[str, list]:
    """The polite crawl itself, on the driver: it is bound by the throttle, one page at a time.

    entries: dicts with url and declaring_type_hint. Members pages and member links of a page join the queue; a link to a
    page that is known but not yet visited corrects its hint. write(rows, final) gets (ord, url, html, version, hint) of
    the pages since the last call: after `every` pages if `gap` seconds have passed since it ended, and always at the
    end, also by an error. say(), a listener, is told after `every` pages how many are done, queued, not cached and
    failed, the recent and overall rates, and the seconds that the queue will take at the mean times of pages fetched and
    cached. Returns what was visited and what failed.
    """
    hints = {e["url"]: e.get("declaring_type_hint") for e in reversed(entries)}
    queue, known = [*dict.fromkeys(e["url"] for e in entries)], {e["url"] for e in entries}
    visited: list[str] = []
    done: set[str] = set()
    failed: list[tuple[str, str]] = []
    rows: list[tuple] = []
    wrote, at = fetcher.clock(), 0
    began, samples, took = wrote, [(0, wrote)], {True: [0, 0.0], False: [0, 0.0]}
    absent = set() if say else None  # of the queue, what the cache does not have; each page is asked for once, when it joins
    if say:
        absent.update(u for u in queue if not _cached(fetcher, u))
    try:
        while at < len(queue) and (most is None or len(visited) < most):
            url = queue[at]
            at += 1
            visited.append(url)
            if say:
                absent.discard(url)
            try:
                cached, asked = _cached(fetcher, url), fetcher.clock() if say else 0.0
                html = fetcher.fetch(url)
                if say:
                    took[cached] = [took[cached][0] + 1, took[cached][1] + fetcher.clock() - asked]
            except Exception as e:
                failed.append((url, str(e)))
                continue
            page = parse.parse_page(url, html, version, hints.get(url))
            if page["kind"] == "unknown":
                failed.append((url, "unknown kind of page"))
            rows.append((len(visited), url, html, version, hints.get(url)))
            own = page["full_type_name"] if page["kind"] in ("class", "struct", "interface", "members_index") else None
            links = [(x["url"], x["declaring_type_hint"] or own) for x in page["links"]] + ([(page["members_page"], own)] if page["members_page"] and own else [])
            done.add(url)
            for to, hint in links:
                if to not in done and f"/{version}/" in to:
                    hints[to] = hint or hints.get(to)
                    if to not in known:
                        known.add(to)
                        queue.append(to)
                        if say and not _cached(fetcher, to):
                            absent.add(to)
            if say and len(visited) % every == 0:
                now, done_then = fetcher.clock(), samples[-6:][0]
                samples.append((len(visited), now))
                missing = len(absent)
                mean = {c: s / n if n else 0.0 for c, (n, s) in took.items()}
                rate = lambda n, s: n / s if s > 0 else 0.0
                left = missing * mean[False] + (len(queue) - at - missing) * mean[True]
                say({"done": len(visited), "queued": len(queue) - at, "uncached": missing, "failed": len(failed), "recent_rate": rate(len(visited) - done_then[0], now - done_then[1]), "overall_rate": rate(len(visited), now - began), "seconds_left": left})
            if len(visited) % every == 0 and fetcher.clock() - wrote >= gap:
                write(rows, False)
                rows, wrote = [], fetcher.clock()
    finally:
        write(rows, True)
    return {"visited": visited, "failed": failed}
