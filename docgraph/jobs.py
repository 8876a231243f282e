"""The jobs of the engine on a folder of tables and reports: full and targeted runs, corroboration, refreshes.

Each job is one run (`sinks.publish`): readers see all that it wrote at once, or nothing of it.

    python -m docgraph.jobs full --pages pages.parquet --out out
    python -m docgraph.jobs manifest --out out --manifest manifest.json
    python -m docgraph.jobs mine --sources checkout --tag 1.0 --out out
    python -m docgraph.jobs descriptors --out out
    python -m docgraph.jobs targeted --pages pages.parquet --out out --target A.B.Type --check A.B.Type:Member
    python -m docgraph.jobs graph --out out
    python -m docgraph.jobs pareto --out out --top 20
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import vocabulary as V
from .operators import classify, community, corroborate, graph, pareto, parse, roles
from .sinks import files, publish, report
from .sinks.observed import observed
from .sinks.publish import Run
from .sources import csharp, tables


LIMITS = ["candidates come from documentation pages alone, until a manifest or descriptor sources are held against them", "pages whose layout is not known give notes and less data"]
NEXT = ["check the candidates against the compiled manifest", "look at the largest groups of unknown relations"]


def _save(df: DataFrame, out: Run, name: str) -> DataFrame:
    """Writes a table and reads it back, so that what follows starts from it."""
    path = out.new(f"{name}.parquet")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _table(spark: SparkSession, out: str | Run, name: str) -> DataFrame:
    path = out.find(f"{name}.parquet") if isinstance(out, Run) else publish.path(spark, out, f"{name}.parquet")
    if path is None:
        raise FileNotFoundError(f"no run has published {name}")
    return spark.read.parquet(path)


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def _read_text(spark: SparkSession, path: str | None) -> str | None:
    return spark.read.text(path, wholetext=True).first()[0] if path else None


def graphs(spark: SparkSession, out: str | Run, label_fn: Callable | None = None) -> graph.Graph:
    """Graph, core, communities, relationship map and pages from the saved candidates; refreshes the summary's section."""
    with publish.run(spark, out) as out:
        g = graph.build(_table(spark, out, "nodes"), _table(spark, out, "edges"))
        c = graph.core(graph.Graph(_save(g.nodes, out, "graph_nodes"), _save(g.edges, out, "graph_edges")))
        assigned = _save(community.assign(c.nodes, c.edges), out, "communities_of")
        named = _save(community.summarise(assigned, c.nodes, c.edges, label_fn=label_fn), out, "communities")
        g = graph.Graph(_save(community.with_communities(_table(spark, out, "graph_nodes"), assigned), out, "graph_nodes"), _table(spark, out, "graph_edges"))
        c = graph.core(g)
        files.json_table(graph.metadata(g).orderBy("axis", "value"), out.new("graph_metadata"), None)
        files.json_table(graph.metadata(c).orderBy("axis", "value"), out.new("graph_core_metadata"), None)
        _save(c.nodes, out, "graph_core_nodes")
        _save(c.edges, out, "graph_core_edges")
        _write_text(spark, out.new("graph.html"), report.graph_page(c))
        _write_text(spark, out.new("roles.html"), report.role_page(roles.relationship_map(c.nodes, c.edges)))
        # both graphs as documents: metadata, nodes and edges, with the same communities
        for name, own in (("graph", g), ("graph_core", c)):
            files.json_table(own.nodes.orderBy("id"), out.new(f"{name}/nodes"), None)
            files.json_table(own.edges, out.new(f"{name}/edges"))
            files.json_table(named.orderBy("community_id"), out.new(f"{name}/communities"), None)
        _refresh(spark, out, "Graph", report.table(graph.metadata(g).orderBy("axis", "value"), 100) + "\n\n" + report.table(named.select("community_id", "label", "size").orderBy("community_id"), 10))
        return g


def _refresh(spark: SparkSession, out: Run, title: str, body: str) -> None:
    text = report.replaced(_read_text(spark, out.find("summary.md")), title, body)
    if text is not None:
        _write_text(spark, out.new("summary.md"), text)


def full(spark: SparkSession, pages: DataFrame, out: str | Run, prefix: str | None = None, with_text: bool = False, label_fn: Callable | None = None) -> graph.Graph:
    """All outputs of cached pages (ord, url, html, version, hint). prefix keeps records of namespaces that start with it."""
    with publish.run(spark, out) as out:
        parsed = parse.parse(pages, F.col("hint") if "hint" in pages.columns else None)
        if prefix:
            parsed = parsed.where(parse.in_namespace(F.col("namespace"), prefix))
        kinds = [k for _, k in V.TITLE_KINDS]
        counted, pages_by_kind = observed(parsed, {"kind": (F.col("kind"), sorted({*kinds}))})
        parsed = _save(counted, out, "parsed")
        files.json_table(pages.select(*[c for c in ("ord", "url", "link_text", "discovered_via", "hint") if c in pages.columns]), out.new("raw_index"))
        files.api_pages(parsed.drop("links", "members_page", "sniffed"), out.new("api_pages"), with_text)
        kept, edges_by_kind = observed(classify.edges(parsed), {"member_kind": (F.col("member_kind"), ["property", "method"]), "confidence": (F.col("edge_confidence"), [*V.CONFIDENCE_ORDER])})
        nodes, edges = _save(classify.nodes(parsed), out, "nodes"), _save(kept, out, "edges")
        # counted while they were written
        _write_text(spark, out.new("metrics.json"), json.dumps({"pages": pages_by_kind(), "edges": edges_by_kind()}, indent=1))
        files.edges_by_kind(edges, out.new("edges_by_kind"))
        files.json_table(files.enum_catalog(parsed), out.new("enums"), None)
        g = graphs(spark, out, label_fn)
        _write_text(spark, out.new("summary.md"), report.summary(parsed, nodes, edges, g, _table(spark, out, "communities"), scope={"namespace": prefix}, limits=LIMITS, next_steps=NEXT))
        return g


def manifest(spark: SparkSession, out: str | Run, path: str) -> None:
    """Checks the saved candidates against a compiled manifest; graph and summary follow."""
    with publish.run(spark, out) as out:
        types = corroborate.manifest_types(tables.manifest(spark, path))
        nodes, edges = _table(spark, out, "nodes"), _table(spark, out, "edges")
        found = corroborate.type_results(nodes, types)
        results = _save(corroborate.edge_results(edges, types), out, "manifest_edges")
        _save(corroborate.undocumented(found, types), out, "manifest_only")
        _save(found, out, "manifest_types")
        _save(_table(spark, out, "manifest_types").select(*nodes.columns), out, "nodes")
        _save(results.select(*edges.columns), out, "edges")
        graphs(spark, out)
        _refresh(spark, out, "Compiled manifest", report.corroboration(results, "dll_verified_status", scope="dll_relationship_scope"))


def mine(spark: SparkSession, sources: str, tag: str, out: str) -> None:
    if not csharp.checkout_matches(sources, tag):
        raise ValueError(f"{sources} does not stand clean at {tag}")
    with publish.run(spark, out) as own:
        _save(csharp.mine(csharp.sources(spark, sources), tag), own, "descriptors")


def descriptors(spark: SparkSession, out: str | Run, path: str | None = None) -> None:
    """Marks the saved edges that descriptor sources refer to; graph and summary follow."""
    with publish.run(spark, out) as out:
        reference = tables.reference(spark, path) if path else _table(spark, out, "descriptors")
        edges = _table(spark, out, "edges")
        results = _save(corroborate.descriptor_results(edges, reference), out, "descriptor_edges")
        _save(corroborate.annotate_descriptors(edges, reference).select(*edges.columns), out, "edges")
        graphs(spark, out)
        _refresh(spark, out, "Descriptor sources", report.corroboration(results, "lookup_referenced"))


def targeted(spark: SparkSession, pages: DataFrame, out: str | Run, targets: list[str], checks: list[tuple[str, str]]) -> None:
    """A full run of the targets' pages, and a report on targets and expected edges."""
    with publish.run(spark, out) as out:
        full(spark, pages, out)
        parsed, edges = _table(spark, out, "parsed"), _table(spark, out, "edges")
        wanted = spark.createDataFrame([(t,) for t in targets], "full_type_name string")
        asked = spark.createDataFrame([(k, *c) for k, c in enumerate(checks)], "check_ord int, source_type string, member_name string")
        members = parsed.select("ord", F.explode("members").alias("m")).select(F.col("m.declaring_type").alias("full_type_name"), F.col("m.name").alias("member_name"), "ord")
        found = corroborate.targets(wanted, parsed.select("full_type_name"), parsed)
        known = corroborate.known_edges(asked, members, classify.chains(parsed).select("full_type_name", "chain"), edges)
        _write_text(spark, out.new("validation.md"), report.validation(found.orderBy("full_type_name"), known.orderBy("check_ord"), parsed, _table(spark, out, "nodes"), edges))


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=["full", "manifest", "mine", "descriptors", "targeted", "graph", "pareto"])
    for name in ("out", "pages", "manifest", "sources", "tag", "reference", "prefix"):
        p.add_argument(f"--{name}")
    p.add_argument("--target", action="append", default=[])
    p.add_argument("--check", action="append", default=[])
    p.add_argument("--top", type=int, default=20)
    p.add_argument("--min-count", type=int, default=1)
    p.add_argument("--with-text", action="store_true")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("docgraph").getOrCreate()
    pages = spark.read.parquet(a.pages) if a.pages else None
    if a.job == "full":
        full(spark, pages, a.out, a.prefix, a.with_text)
    elif a.job == "manifest":
        manifest(spark, a.out, a.manifest)
    elif a.job == "mine":
        mine(spark, a.sources, a.tag, a.out)
    elif a.job == "descriptors":
        descriptors(spark, a.out, a.reference)
    elif a.job == "targeted":
        targeted(spark, pages, a.out, a.target, [tuple(c.split(":", 1)) for c in a.check])
    elif a.job == "graph":
        graphs(spark, a.out)
    else:
        rows = pareto.clusters(_table(spark, a.out, "edges"))
        with publish.run(spark, a.out) as out:
            files.csv_table(rows, out.new("pareto"))
        print(report.table(pareto.totals(_table(spark, a.out, "edges"))))
        print(report.table(pareto.shown(rows.drop("examples").withColumn("first", F.to_json("first")), a.top, a.min_count), a.top))


if __name__ == "__main__":
    main()
