"""Resolution, communities, corroboration, discovery, mining, sinks, reports, streaming."""

import json

import pytest
from pyspark.sql import functions as F

from docgraph import schemas
from docgraph.operators import community, corroborate, graph, progress, roles
from docgraph.operators.resolve import two_pass
from docgraph.sinks import files, report
from docgraph.sources import csharp, discover, fetch, tables
from docgraph.streaming import crawl


def test_two_pass_counts_equal_rows_as_ambiguous(spark):
    known = spark.createDataFrame([("A.X", "X"), ("B.X", "X"), ("C.Y", "Y"), ("D.Z", "Z"), ("D.Z", "Z")], "full string, short string")
    asked = spark.createDataFrame([("A.X",), ("Q.X",), ("Q.Y",), ("Q.Z",), ("",), (None,)], "q string")
    got = {r.q: (r.resolved, r.resolved_how) for r in two_pass(asked, "q", known, "full", "short").collect()}
    assert got == {"A.X": ("A.X", "exact"), "Q.X": (None, "external"), "Q.Y": ("C.Y", "short_name_fallback"), "Q.Z": (None, "external"), "": (None, "none"), None: (None, "none")}


def test_two_triangles():
    pairs = [(a, b, 1) for a, b in (("0", "1"), ("1", "2"), ("0", "2"), ("3", "4"), ("4", "5"), ("3", "5"), ("2", "3"))]
    assert community.local_moves(pairs) == {"0": 0, "1": 0, "2": 0, "3": 1, "4": 1, "5": 1}


def test_communities(spark):
    n = spark.createDataFrame([(x, x) for x in "abcdefg"], "id string, short_name string")
    e = spark.createDataFrame([(i, *p) for i, p in enumerate([("a", "b"), ("b", "c"), ("a", "c"), ("d", "e"), ("e", "f"), ("d", "f"), ("c", "d"), ("g", "g"), ("a", None)])], "ord long, source string, target string")
    found = community.detect(n, e)
    assert {r.id: r.community_id for r in found.collect()} == {**dict.fromkeys("abc", 0), **dict.fromkeys("def", 1)}
    s = {r.community_id: r for r in community.summarise(found, n, e, label_fn=lambda ids: "mine" if "a" in ids else 1 / 0).collect()}
    assert (s[0].label, s[0].label_source, s[1].label, s[1].label_source) == ("mine", "given", "d · e · f", "heuristic")
    assert {r.id: (r.ends, r.degree) for r in graph.ends_count(n, e).collect()}["g"] == (2, 1)
    assert sorted(map(tuple, community.assign(n, e).collect())) == sorted(map(tuple, found.collect()))
    assert sorted(map(tuple, community.assign(n, e, few=0).collect())) == sorted(map(tuple, found.collect()))


def manifest(spark, tmp_path, types):
    at = tmp_path / "m.json"
    at.write_text("﻿" + json.dumps({"revit_version": "1", "types": types}), encoding="utf-8")
    return tables.manifest(spark, str(at))


def test_corroboration(spark, tmp_path):
    member = lambda n, r, *ps: {"name": n, "kind": "method", "declaring_type": None, "return_type": r, "parameters": [{"name": "x", "type": p} for p in ps]}
    m = manifest(spark, tmp_path, [
        {"full_type_name": "N.Base", "kind": "class", "members": [member("Up", "System.Int32"), member("Two", "A"), member("Two", "B")]},
        {"full_type_name": "N.Own", "kind": "class", "inheritance_chain": ["N.Base"], "members": [member("Get", None, "System.String"), member("Get", None, "out N.Foo"), member("Two", "C")]},
        {"full_type_name": "N.Outer+In", "kind": "class", "members": []},
    ])
    types = corroborate.manifest_types(m)
    nodes = spark.createDataFrame([("N.Own", None), ("Z.Outer.In", None), ("N.Outer.In", None), ("N.No", None)], "full_type_name string, dll_type_verified boolean")
    r = corroborate.type_results(nodes, types)
    assert {x.full_type_name: (x.status, x.resolution) for x in r.collect()} == {"N.Own": ("confirmed", "exact"), "Z.Outer.In": ("confirmed", "short_name_fallback"), "N.Outer.In": ("confirmed", "exact"), "N.No": ("doc_only", "none")}
    assert [x[0] for x in corroborate.undocumented(r, types).collect()] == ["N.Base"]
    e = spark.createDataFrame([(1, "N.Own", "Get", "method", "void", ["string"]), (2, "N.Own", "Up", "method", "int", []), (3, "N.Own", "Two", "method", "B", []), (4, "N.Own", "Two", "method", "X", []), (5, "N.Own", "None", "method", "X", []), (6, "Q.Q", "Get", "method", "X", [])], "ord long, source_type string, member_name string, member_kind string, return_type string, parameter_types array<string>")
    got = {x.ord: (x.dll_verified_status, x.dll_relationship_scope, x.actual_return_type) for x in corroborate.edge_results(e, types).collect()}
    assert got == {1: ("signature_confirmed", "declared", None), 2: ("signature_confirmed", "inherited", "System.Int32"), 3: ("signature_confirmed", "inherited", "B"), 4: ("signature_mismatch", "declared", "C"), 5: ("member_not_found", None, None), 6: ("member_not_found", None, None)}
    assert {(x.what, x.value): x.n for x in tables.manifest_summary(m).collect()}["by_reference", "out"] == 1


def test_known_edges_through_ancestors(spark):
    checks = spark.createDataFrame([(1, "N.A", "M"), (2, "N.A", "P"), (3, "N.A", "Q")], "check_ord long, source_type string, member_name string")
    members = spark.createDataFrame([("N.A", "M", 1), ("X.Base", "P", 2), ("N.Other", "Q", 3)], "full_type_name string, member_name string, ord long")
    chains = spark.createDataFrame([("N.A", ["Base"])], "full_type_name string, chain array<string>")
    edges = spark.createDataFrame([("X.Base", "P", "E", "T", 1)], "source_type string, member_name string, candidate_edge_type string, candidate_target_type string, ord long")
    got = {r.check_ord: (r.member_found, r.edge_found) for r in corroborate.known_edges(checks, members, chains, edges).collect()}
    assert got == {1: (True, False), 2: (True, True), 3: (False, False)}


TREE = json.dumps({"children": [
    {"title": "A.B Namespace", "children": [{"title": "T Class", "tag": "Class", "href": "t.htm", "children": [{"title": "M Method", "tag": "Method", "href": "m.htm"}, {"title": "again", "href": "t.htm"}]}]},
    {"title": "A.BC Namespace", "children": [{"title": "U Class", "tag": "Class", "href": "u.htm"}]}, {"title": "A.B.C Namespace", "children": [{"title": "V Class", "tag": "Class", "href": "v.htm"}]},
]})


def test_toc():
    rows = discover.toc_rows(TREE, "http://h/1/", "A.B")
    assert [(r["url"], r["declaring_type_hint"]) for r in rows] == [("http://h/1/t.htm", "A.B.T"), ("http://h/1/m.htm", "A.B.T"), ("http://h/1/t.htm", "A.B.T"), ("http://h/1/v.htm", "A.B.C.V")]
    assert [r["url"] for r in discover.toc_rows(TREE, "http://h/1/", "A.B", ["A.B.C.V", "A.B.X"])] == ["http://h/1/v.htm"]
    assert discover.toc_rows("{", "", "A") == []
    kinds = json.dumps({"children": [{"title": "A Namespace", "children": [{"title": f"N{k} {w}", "tag": t, "href": f"{k}.htm"} for k, (w, t) in enumerate([("Struct", "Struct"), ("Structure", "Structure"), ("Enum", "Enum"), ("Enumeration", "Enumeration"), ("Interface", "Interface")])]}]})
    assert [r["full_name"] for r in discover.toc_rows(kinds, "", "A")] == [f"A.N{k}" for k in range(5)]


def test_discovery_merge(spark):
    toc = discover.from_toc(spark.createDataFrame([(TREE,)], "text string"), "http://h/1/", "A.B")
    html = spark.createDataFrame([("http://h/1/", "<a href=t.htm>new</a><a href='http://other/1/x.htm'>y</a><script>\"1/0123456789ab.htm\"</script>")], "url string, html string")
    page = discover.from_html(html, "root_page_anchor", "h", "1", "http://h/")
    site = discover.from_sitemap(spark.createDataFrame([("http://h/sitemap.xml", "<u xmlns='x'><loc> http://h/1/s.htm </loc><loc>http://z/1/s.htm</loc></u>"), ("http://h/b.xml", "<broken")], "url string, text string"), "h", "1")
    got = discover.merge([toc, page, site]).collect()
    assert [(r.url, r.discovered_via, r.declaring_type_hint) for r in got] == [
        ("http://h/1/t.htm", "root_page_anchor", None), ("http://h/1/m.htm", "namespace_json:Method", "A.B.T"), ("http://h/1/v.htm", "namespace_json:Class", "A.B.C.V"), ("http://h/1/0123456789ab.htm", "root_page_anchor:regex_guid", None), ("http://h/1/s.htm", "sitemap_xml", None),
    ]
    assert discover.safely({"a": lambda: 1, "b": lambda: 1 / 0})[0] == [1]


def test_fetch(tmp_path):
    seen, slept = [], []

    def get(url):
        seen.append(url)
        if url.endswith("robots.txt"):
            return 200, "User-agent: *\nDisallow: /no\nCrawl-delay: 3"
        return 200, "page " + url

    f = fetch.Fetcher({"h"}, str(tmp_path), 1.0, get=get, clock=lambda: 10.0, sleep=slept.append)
    assert f.fetch("http://h/a") == f.fetch("http://h/a") == "page http://h/a" and f.is_cached("http://h/a")
    f.fetch("http://h/b")
    assert seen == ["http://h/robots.txt", "http://h/a", "http://h/b"] and slept == [3.0]
    for bad in ("http://h/no/x", "http://other/a"):
        with pytest.raises(fetch.HttpError):
            f.fetch(bad)


def test_decompress():
    import gzip
    import zlib

    raw = zlib.compressobj(wbits=-15)
    assert {fetch.decompressed(x, e) for x, e in ((gzip.compress(b"x"), "gzip"), (zlib.compress(b"x"), "deflate"), (raw.compress(b"x") + raw.flush(), "deflate"), (b"x", None))} == {b"x"}


MAP = """using Alias = A.B.Real;
switch {
    //Root
    Alias value when value.X == 1 => new OneDescriptor(value),
    A.B.Two => new TwoDescriptor(),
    null => new NullDescriptor(), _ => new OtherDescriptor()
"""
SOURCE = """class OneDescriptor : IDescriptorResolver, IDescriptorExtension {
  public ResolveSet Resolve(Document context, string target, ParameterInfo[] parameters) {
    return target switch {
      nameof(Real.Get) when parameters.Length == 0 => ResolveSet.Append(context.Get()),
      "Lit" => Local(),
#if X
      nameof(Plain) => Other,
#endif
      nameof(Many) => new Variants<int>(2).Add(1)
    };
    ResolveSet Local() { if (a) { b(); } return RevitApi.Document.X; }
  }
  public void RegisterExtensions(IExtensionManager manager) { manager.Register(nameof(E.First), _ => 1); x.Name = "Second"; }
}"""


def test_mining(spark, tmp_path):
    root = tmp_path / "PlaygroundRoot" / "src"
    (root / "Playground").mkdir(parents=True)
    (root / "DescriptorMap.cs").write_text(MAP)
    (root / "OneDescriptor.cs").write_text(SOURCE)
    (root / "Playground" / "BadDescriptor.cs").write_text("class BadDescriptor {}")
    r = csharp.mine(csharp.sources(spark, str(root)), "t").first()
    assert [(m.target_type_short_name, m.descriptor_class, m.section) for m in r.descriptor_map] == [("Real", "OneDescriptor", "Root"), ("Two", "TwoDescriptor", "Root")]
    (d,) = r.descriptors
    assert [(m.member_name, m.name_source, m.requires_document_context, m.has_multiple_variants) for m in d.resolved_members] == [("Get", "nameof", True, False), ("Lit", "string_literal", True, False), ("Plain", "nameof", False, False), ("Many", "nameof", True, True)]  # the last arm reaches to the end of the method
    assert d.synthetic_extensions == ["First", "Second"]
    assert csharp.descriptor("IDescriptorResolver")["parser_notes"] and csharp.checkout_matches(str(tmp_path), "t")


def test_sinks(spark, tmp_path):
    e = spark.createDataFrame([(1, "A", "M", True)], "ord long, source_type string, member_name string, lookup_referenced boolean")
    assert json.loads(files.json_array(e)) == [{"source_type": "A", "member_name": "M", "revitlookup_referenced": True}]
    full = spark.createDataFrame([], schemas.EDGES).withColumn("ord", F.lit(1))
    full = full.unionByName(e, allowMissingColumns=True)
    (tmp_path / "e.json").write_text(files.json_array(full))
    back = tables.edges(spark, str(tmp_path / "e.json")).first()
    assert back.lookup_referenced is True and back.dll_signature_verified is None and back.source_type == "A"


def test_section_upsert():
    text = "# S\n\n## 1. A\n\nold\n\n## 2. B\n\nb\n"
    once = report.replaced(text, "A", "new")
    assert once == "# S\n\n## 1. A\n\nnew\n\n## 2. B\n\nb\n" and report.replaced(once, "A", "new") == once
    assert report.replaced(text, "C", "c").endswith("## C\n\nc\n") and report.replaced(None, "A", "x") is None and report.replaced(text, "A", " ") == text
    assert "<\\/script>" in report.embedded("<script>D</script>", "D", {"x": "</script>"})


def test_relationship_map(spark):
    n = spark.createDataFrame([("N.Wall", "Wall", None, "element_subtype"), ("N.Material", "Material", None, ""), ("N.FamilySymbol", "FamilySymbol", None, "")], "id string, short_name string, base_type string, class_role string")
    e = spark.createDataFrame([(1, "N.Wall", "N.FamilySymbol", "INSTANCE_OF"), (2, "N.Wall", "N.FamilySymbol", "INSTANCE_OF"), (3, "N.Wall", "N.Material", "USES_MATERIAL"), (4, "N.Wall", "N.Gone", "USES_MATERIAL")], "ord long, source string, target string, edge_type string")
    m = roles.relationship_map(n, e, k=1)
    assert [tuple(r) for r in m["triples"].collect()] == [("Element", "INSTANCE_OF", "FamilySymbol", 2)] and tuple(m["disclosed"].first()) == (3, 2)
    assert "<svg" in report.flow_chart(m["triples"])


def test_progress(spark):
    log = spark.createDataFrame([("r", i, float(2 * i), i) for i in range(1, 80)], "run string, seq long, elapsed double, pages long")
    assert {r.trailing_rate for r in progress.rates(log, ["run"]).collect()} == {0.5}
    assert [r.pages for r in progress.due(log, 5, 30.0).orderBy("pages").collect()] == [5, 20, 35, 50, 65]


def test_stream(spark, tmp_path):
    page = "<script>\"namespace\": \"N\"</script><h1>{0} Class</h1><pre class=code>public class {0}</pre>"
    src = tmp_path / "in"
    for k, names in enumerate((["A", "B"], ["B", "C"])):
        spark.createDataFrame([(k * 10 + i, f"u{x}", page.format(x), "1", None) for i, x in enumerate(names)], "ord long, url string, html string, version string, hint string").coalesce(1).write.mode("append").parquet(str(src))
    said = []
    crawl.stream(spark, str(src), str(tmp_path / "cp"), lambda out, final: said.append((final, sorted(r.short_name for r in out["nodes"].collect()))), str(tmp_path / "pages"))
    assert said[-1] == (True, ["A", "B", "C"]) and said[0][0] is False


@pytest.mark.parametrize("last, ranges", [(4, 7), (50, 3), (1, 5)])
def test_trailing_mean_over_ranges(spark, last, ranges):
    rows = [(k * k % 101, ("a", "b")[k % 11 == 0], float(k % 13) if k % 7 else None) for k in range(101)]
    rows = [(s, k, v) for s, (k, v) in {s: (k, v) for s, k, v in rows}.items()]
    log = spark.createDataFrame(rows, "seq long, k string, v double")
    got = {r.seq: r.trailing_mean for r in progress.trailing_mean(log, "v", ["k"], "seq", last, -1.0, ranges).collect()}
    for s, k, _ in rows:
        own = [v for t, j, v in sorted(rows) if j == k and t <= s][-last:]
        own = [v for v in own if v is not None]
        assert got[s] == pytest.approx(sum(own) / len(own) if own else -1.0)
    assert len(got) == len(rows) and progress.trailing_mean(log.where("false"), "v", ["k"], "seq").count() == 0


def test_frontier(spark):
    links = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "y")], "url string, to string")
    seeds = spark.createDataFrame([("a",)], "url string")
    assert {(r.url, r.round) for r in crawl.frontier(seeds, links).collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert crawl.frontier(seeds, links, most=2).count() == 2


def test_sketches_of_batches(spark):
    """Merging is the same in any order and grouping, and the error is within four standard errors."""
    from docgraph.operators import pareto

    rows = [(k, f"T{k % 5000}", f"M{k % 7}", f"A.X{k % 2}", "UNKNOWN_DB_OBJECT_REFERENCE", "needs_runtime_validation" if k % 3 else "direct_return_type", k % 4 == 0, None) for k in range(20000)]
    e = spark.createDataFrame(rows, "ord long, source_type string, member_name string, candidate_target_type string, candidate_edge_type string, edge_confidence string, lookup_referenced boolean, dll_verified_status string")
    parts = [pareto.state(e.where(F.col("ord") % 3 == k)) for k in range(3)]
    one = sorted(map(tuple, pareto.estimated(pareto.state(e)).collect()))
    assert sorted(map(tuple, pareto.estimated(pareto.merged(parts[2].union(parts[0])).union(parts[1])).collect())) == one
    exact = {(r.axis, r.key): r for r in pareto.clusters(e).collect()}
    assert len(one) == len(exact) == 4
    for axis, key, count, sources, members, *_ in one:
        x = exact[axis, key]
        assert count == x["count"] and members == x.member_names and abs(sources - x.source_types) <= 4 * 1.04 / 64 * x.source_types


def test_sketches_depend_on_edges_alone(spark):
    """Estimates of merged batches are those of one pass at any number of distinct values, also past each size of a sketch; few values,
    and missing ones among them, are counted exactly."""
    from docgraph.operators import pareto

    sizes = [1, 300, 1000, 1724, 3000, 20000]
    e = spark.range(2 * sum(sizes), numPartitions=5).select(F.col("id").alias("ord"), F.element_at(F.array(*[F.lit(n) for n in sizes]), (F.col("id") % len(sizes) + 1).cast("int")).alias("n"), F.floor(F.col("id") / len(sizes)).alias("m"))
    e = e.select("ord", F.when(F.col("m") % F.col("n") > 0, F.concat(F.lit("P"), F.col("m") % F.col("n"))).alias("source_type"), F.lit(None).cast("string").alias("member_name"), F.concat(F.lit("A.X"), "n").alias("candidate_target_type"), F.lit("UNKNOWN_DB_OBJECT_REFERENCE").alias("candidate_edge_type"), F.lit("x").alias("edge_confidence"), F.lit(False).alias("lookup_referenced"), F.lit(None).cast("string").alias("dll_verified_status"))
    for bits in ((), (8,)):
        one = {r.key: r for r in pareto.estimated(pareto.state(e, *bits), *bits).collect()}
        four = [pareto.state(e.where(F.col("ord") % 28 % 4 == k), *bits) for k in range(4)]
        again = pareto.merged(four[3].union(four[1]), *bits).union(pareto.merged(four[0], *bits)).union(four[2])
        for states in (four[0].union(four[1]).union(four[2]).union(four[3]), again):
            assert {r.key: r for r in pareto.estimated(states, *bits).collect()} == one
        kept = 2 ** (*bits, pareto.BITS)[0]
        for r in pareto.clusters(e).collect():
            x = one[r["key"]]
            assert x["count"] == r["count"] and x.member_names == r.member_names == 1
            assert x.source_types == r.source_types if r.source_types <= kept else abs(x.source_types - r.source_types) <= 4 / kept**0.5 * r.source_types
