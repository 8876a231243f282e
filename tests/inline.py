"""Operators on inline pages, declarations, sources and small graphs, whose results are worked out by hand."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from docgraph.functions import html as H
from docgraph.functions import text as X
from docgraph.functions import typenames
from docgraph.functions import vocabulary as V
from docgraph.operators import classify, community, corroborate, graph, parse, pareto, progress, roles
from docgraph.operators.parse import udf
from docgraph.plans.registry import sql_values
from docgraph.plans.typed import EXPECTED, MEMBERS
from docgraph.sources import csharp, discover, tables
from docgraph.streaming import crawl

CASES, SQL = {}, {}


def query(sql: str):
    """Registers a case with the SQL of its result."""

    def put(f):
        CASES[f.__name__], SQL[f.__name__] = f, sql
        return f

    return put


DB = V.DB_NAMESPACE
SPACE = f'<script>var x = {{"namespace": "{DB}"}};</script>'


def expected(rows: list[tuple], names: str) -> str:
    """SQL of the rows, under the names, in any order."""
    return f"SELECT * FROM {sql_values(rows, names)}"


def frame(spark, rows, schema: str):
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def parsed(spark, pages: list[tuple]):
    """pages: (url, html, hint), parsed in their order."""
    rows = [(k, url, html, "7", hint) for k, (url, html, hint) in enumerate(pages)]
    return parse.parse(frame(spark, rows, "ord long, url string, html string, version string, hint string"), F.col("hint"))


# pages

TITLES = [
    ("Door Class", "Door", "class"), ("Swing Structure", "Swing", "struct"), ("Swing Struct", "Swing", "struct"), ("Side Enumeration", "Side", "enum"), ("Side Enum", "Side", "enum"), ("IOpen Interface", "IOpen", "interface"),
    ("Door.Width Property", "Door.Width", "property"), ("Door.Open Method (Int32, IList(ElementId))", "Door.Open", "method"), ("Door Constructor", "Door", "constructor"), ("Door Members", "Door", "members_index"), ("Door Methods", "Door", "members_index"), ("Door Properties", "Door", "members_index"), ("Welcome", "Welcome", "unknown"), ("", "", "unknown"),
]


@query(expected([(k, name, kind) for k, (_, name, kind) in enumerate(TITLES)], "k, name, kind"))
def page_title_kinds(t, spark):
    own = udf(lambda text: dict(zip(("name", "kind"), parse.title_kind(text), strict=True)), "struct<name:string,kind:string>")
    return frame(spark, [(k, x[0]) for k, x in enumerate(TITLES)], "k int, title string").select("k", own("title").alias("x")).select("k", "x.*")


@query(expected([(0, "api title"), (1, "heading one"), (2, "page header"), (3, "in the head"), (4, "")], "k, title"))
def page_title_order(t, spark):
    """The title is the first that there is of four places."""
    places = ["<title>in the head</title>", "<div id=PageHeader>page <b>header</b></div>", "<h1>heading  <i>one</i></h1>", "<p id='api-title'>api title</p>"]
    rows = [(k, "".join(places[: 4 - k])) for k in range(5)]
    return frame(spark, rows, "k int, html string").select("k", parse.title_udf("html").alias("title"))


@query(expected([(0, DB, 0), (1, f"{V.ROOT_NAMESPACE}.UI", 0), (2, f"{V.ROOT_NAMESPACE}.DB.Doors", 0), (3, "", 1)], "k, namespace, notes"))
def page_namespaces(t, spark):
    """From embedded JSON, else a breadcrumb, else the text; a note if there is none."""
    rows = [
        SPACE + f"<div id=TopicPathClassic><a>{V.ROOT_NAMESPACE}.UI</a></div>", f"<div id=TopicPathClassic><a>Home</a><a>{V.ROOT_NAMESPACE}.UI</a></div>Namespace: {V.ROOT_NAMESPACE}.X", f"<p>Namespace:</p><p>{V.ROOT_NAMESPACE}.DB.Doors</p>", "<p>nothing</p>",
    ]
    own = udf(lambda h: dict(zip(("namespace", "n"), ((x := parse.namespace(H.tree(h), h))[0], len(x[1])), strict=True)), "struct<namespace:string,n:int>")
    return frame(spark, enumerate(rows), "k int, html string").select("k", own("html").alias("x")).select("k", "x.namespace", F.col("x.n").alias("notes"))


BASES = [
    ("public class Door : Opening, IDisposable", "Opening", "IDisposable"), ("public abstract class Opening", None, ""), ("public interface IOpen : IClose, ILock", None, "IClose,ILock"), ("public enum Side : int", "int", ""), ("public struct Swing : A.B.Base", "A.B.Base", ""), ("public class Door<T> : Opening", None, ""), ("public void Open()", None, ""),
]


@query(expected([(s, b, i) for s, b, i in BASES], "syntax, base, interfaces"))
def declaration_bases(t, spark):
    own = udf(lambda s: dict(zip(("base", "interfaces"), ((x := parse.bases(s))[0], ",".join(x[1])), strict=True)), "struct<base:string,interfaces:string>")
    return frame(spark, [(s,) for s, _, _ in BASES], "syntax string").select("syntax", own("syntax").alias("x")).select("syntax", "x.*")


SIGNATURES = [
    ("public void Open ( int angle, bool lock )", "void", "int angle|bool lock"), ("public double Width { get; set; }", "double", ""), ("public static IList < ElementId > Find( Document d )", "IList < ElementId >", "Document d"), ("public A.B[] All ()", "A.B[]", ""),
    ("public int? Count( IDictionary<string, IList<int>> m, out double[,] n )", "int?", "IDictionary<string, IList<int>> m|out double[,] n"), ("public Door this[int k] { get; }", None, ""), ("Door", None, ""),
]


@query(expected([(s, r, p) for s, r, p in SIGNATURES], "syntax, returns, parameters"))
def declaration_signatures(t, spark):
    own = udf(lambda s: dict(zip(("returns", "parameters"), ((x := parse.signature(s))[0], "|".join(f"{p['type']} {p['name']}" for p in x[1])), strict=True)), "struct<returns:string,parameters:string>")
    return frame(spark, [(s,) for s, _, _ in SIGNATURES], "syntax string").select("syntax", own("syntax").alias("x")).select("syntax", "x.*")


GROUPS = [("Open Method (A, B(C))", "Open Method"), ("Open (A) Method", "Open (A) Method"), ("Open)", "Open)"), ("(A)", ""), ("Open ((A)", "Open ("), ("", "")]
PARTS = [("A<B,C>,D", "A<B,C>;D"), ("A[1,2],B", "A[1,2];B"), ("A>,B", "A>;B"), ("A,", "A"), ("A,,B", "A;;B"), ("A<B<C,D>,E>,F", "A<B<C,D>,E>;F")]


@query(expected([(a, b) for a, b in GROUPS] + PARTS, "text, result"))
def balanced_brackets(t, spark):
    groups = frame(spark, [(a,) for a, _ in GROUPS], "text string").select("text", udf(X.without_trailing_group, "string")("text").alias("result"))
    return groups.union(frame(spark, [(a,) for a, _ in PARTS], "text string").select("text", udf(lambda s: ";".join(X.top_level_parts(s)), "string")("text")))


MARKUP = "<div id=top class='a b'><p>one<br>two<ul><li class=x>three</li><li>four</ul><p>five</div><div class=b>six</b></div>"
SELECTED = [("div", "onetwothreefourfive|six"), ("div.a.b", "onetwothreefourfive"), ("#top li", "three|four"), ("li.x", "three"), ("div > p", "onetwothreefourfive"), ("p > p", "five"), ("#top p:first-of-type", "onetwothreefourfive|five"), ("ul li:first-of-type", "three"), ("b", "")]


@query(expected([(s, r) for s, r in SELECTED], "selector, texts"))
def html_selectors(t, spark):
    """<p> and <ul> that are not closed hold what follows; </ul> closes its list item too; a stray closing tag is nothing."""
    own = udf(lambda s: "|".join(n.text() for n in H.tree(MARKUP).select(s)), "string")
    return frame(spark, [(s,) for s, _ in SELECTED], "selector string").select("selector", own("selector").alias("texts"))


DOOR = (
    SPACE + "<h1>Door Class</h1><div class=summary>Opens.</div><div id=remarksSection>Often.</div><pre class=code>public class Door : Opening, ILock</pre><div class=seeAlsoStyle><a>Wall</a><a> </a><a>Opening</a></div>"
    '<table class="members"><tr><td>i</td><td><a href="w.htm">Width</a></td><td>How wide</td></tr><tr data="public;inherited"><td>i</td><td><a href="../id.htm">Id</a></td><td>(Inherited from Base.)</td></tr><tr data="inherited"><td>i</td><td><a href="n.htm">None</a></td><td>-</td></tr><tr><td>i</td><td><a href="o.htm">Open(Int32)</a></td><td>Opens</td></tr></table>'
    "<table id=bottomTable><tr><td><a href=all.htm>Members</a></td></tr></table>"
)
SIDE = SPACE + "<h1>Side Enumeration</h1><table class=enumeration><tr><td>Member name</td><td>Value</td><td>Description</td></tr><tr><td>Left</td><td>-1</td><td>to the left</td></tr><tr><td>Right</td><td>0x1</td><td></td></tr><tr><td>Both</td><td>of them</td></tr><tr><td>Odd</td></tr></table>"
INDEX = SPACE + "<h1 id=api-title>Door Members</h1><div id=mainBody><h1 class=heading>Methods</h1><table class=members><tr><td></td><td><a href=o.htm>Open</a></td><td></td></tr></table><span class=collapsibleRegionTitle>Properties</span><table id=memberList><tr><td></td><td><a href=w.htm>Width</a></td><td></td></tr></table><h1 class=heading>Fields</h1><table class=memberTable><tr><td></td><td><a href=f.htm>Frame</a></td><td></td></tr><tr><td>alone</td></tr></table></div>"
PAGES = [
    ("http://h/7/door.htm", DOOR, None), ("http://h/7/side.htm", SIDE, None), ("http://h/7/index.htm", INDEX, None), ("http://h/7/w.htm", SPACE + "<h1>Door.Width Property</h1><pre class=code>public double Width { get; }</pre>", f"{DB}.Door"), ("http://h/7/c.htm", SPACE + "<h1>Door Constructor</h1><pre class=code>public Door( int a )</pre>", f"{DB}.Door"),
    ("http://h/7/x.htm", "<h1>Door.Shut Method</h1>", None), ("http://h/7/odd.htm", "<p>words</p>", None),
]


@query(expected([
    ("http://h/7/door.htm", "class", f"{DB}.Door", "Opening", "ILock", "Opens.", "Often.", "Wall|Opening", "http://h/7/all.htm"), ("http://h/7/side.htm", "enum", f"{DB}.Side", None, "", "", "", "", None), ("http://h/7/index.htm", "members_index", f"{DB}.Door", None, "", "", "", "", None),
    ("http://h/7/w.htm", "property", f"{DB}.Door.Width", None, "", "", "", "", None), ("http://h/7/c.htm", "constructor", f"{DB}.Door.Door", None, "", "", "", "", None), ("http://h/7/x.htm", "method", "Shut", None, "", "", "", "", None), ("http://h/7/odd.htm", "unknown", "", None, "", "", "", "", None),
], "url, kind, full_type_name, base_type, interfaces, summary, remarks, see_also, members_page"))
def page_records(t, spark):
    p = parsed(spark, PAGES)
    return p.select(F.col("source_url").alias("url"), "kind", "full_type_name", "base_type", F.array_join("implemented_interfaces", "|").alias("interfaces"), "summary", "remarks", F.array_join("see_also", "|").alias("see_also"), "members_page")


@query(expected([
    ("Door", "Width", "property", None, ""), ("Door", "Id", "property", None, ""), ("Door", "None", "property", None, ""), ("Door", "Open", "method", None, ""), ("Width", "Width", "property", "double", ""), ("Door", "Door", "method", None, "int a"), ("Shut", "Shut", "method", None, ""),
], "type_name, name, kind, return_type, parameters"))
def page_members(t, spark):
    """Stubs of a type page's table, and the one member of a member's page; a constructor returns nothing."""
    m = parsed(spark, PAGES).select("type_name", F.explode("members").alias("m"))
    return m.select("type_name", "m.name", "m.kind", "m.return_type", F.array_join(F.transform("m.parameters", lambda x: F.concat_ws(" ", x["type"], x["name"])), "|").alias("parameters"))


@query(expected([
    ("class", "Width", "http://h/7/w.htm", None, None), ("class", "Id", "http://h/id.htm", None, f"{DB}.Base"), ("class", "Open(Int32)", "http://h/7/o.htm", None, None), ("members_index", "Open", "http://h/7/o.htm", "method", None), ("members_index", "Width", "http://h/7/w.htm", "property", None), ("members_index", "Frame", "http://h/7/f.htm", None, None),
], "kind, name, url, member_kind, declaring_type_hint"))
def page_links(t, spark):
    """An inherited row names its owner, or is left out; in an index the last heading before a table names the kind."""
    return parsed(spark, PAGES).select("kind", F.explode("links").alias("x")).select("kind", "x.name", "x.url", "x.member_kind", "x.declaring_type_hint")


@query(expected([("Side", "Left", "-1", "to the left"), ("Side", "Right", None, ""), ("Side", "Both", None, "of them")], "enum_name, member_name, numeric_value, description"))
def page_enum_members(t, spark):
    return parsed(spark, PAGES).select(F.explode("enum_members").alias("m")).select("m.enum_name", "m.member_name", "m.numeric_value", "m.description")


@query(expected([("http://h/7/index.htm", "members table under unknown heading 'Fields'"), ("http://h/7/x.htm", "no namespace in embedded JSON, breadcrumb or text"), ("http://h/7/x.htm", "no syntax block"), ("http://h/7/odd.htm", "no title"), ("http://h/7/odd.htm", "no namespace in embedded JSON, breadcrumb or text"), ("http://h/7/odd.htm", "no syntax block"), ("http://h/7/odd.htm", "no members table")], "url, note"))
def page_notes(t, spark):
    return parsed(spark, PAGES).select(F.col("source_url").alias("url"), F.explode("parser_notes").alias("note"))


@query(expected([(2, "http://h/7/index.htm", "index"), (0, "http://h/7/door.htm", "type"), (1, "http://h/7/side.htm", "enum"), (3, "http://h/7/w.htm", "member"), (4, "http://h/7/c.htm", "member"), (5, "http://h/7/x.htm", "member"), (6, "http://h/7/odd.htm", "failed")], "ord, url, done"))
def page_dispatch(t, spark):
    out = None
    for name, rows in crawl.dispatch(parsed(spark, PAGES)).items():
        own = rows.select(F.col("ord").cast("int").alias("ord"), F.col("source_url").alias("url"), F.lit(name).alias("done"))
        out = own if out is None else out.union(own)
    return out


# discovery

TOC = json.dumps([{"title": "Root", "children": [
    {"title": "N.A Namespace", "children": [{"title": "Door Class", "tag": "Class", "href": "d.htm", "children": [{"title": "Open Method", "tag": "Method", "href": "o.htm"}, {"title": "Door again", "href": "d.htm"}, {"title": "Inner Struct", "tag": "Struct", "href": "i.htm", "children": [{"title": "X Property", "tag": "Property", "href": "x.htm"}]}]}]},
    {"title": "N.A.Sub Namespace", "children": [{"title": "Side Enum", "tag": "Enum", "href": "s.htm"}, {"title": "Loose", "tag": "Page", "href": "l.htm"}]}, {"title": "N.AB Namespace", "children": [{"title": "No Class", "tag": "Class", "href": "n.htm"}]},
]}])


@query(expected([
    ("http://h/7/d.htm", "Door Class", "namespace_json:Class", "N.A.Door"), ("http://h/7/o.htm", "Open Method", "namespace_json:Method", "N.A.Door"), ("http://h/7/i.htm", "Inner Struct", "namespace_json:Struct", "N.A.Inner"), ("http://h/7/x.htm", "X Property", "namespace_json:Property", "N.A.Inner"),
    ("http://h/7/s.htm", "Side Enum", "namespace_json:Enum", "N.A.Sub.Side"), ("http://h/7/l.htm", "Loose", "namespace_json:Page", None),
], "url, link_text, discovered_via, declaring_type_hint"))
def toc_entries(t, spark):
    return discover.from_toc(frame(spark, [(TOC,)], "text string"), "http://h/7/", "N.A").select("url", "link_text", "discovered_via", "declaring_type_hint")


@query(expected([("N.A.Inner", True, "http://h/7/i.htm"), ("N.A.Inner", True, "http://h/7/x.htm"), ("N.A.Missing", False, None)], "full_type_name, found, url"))
def toc_targets(t, spark):
    """Subtrees of wanted types only, and which of them there are."""
    wanted = ["N.A.Inner", "N.A.Missing"]
    entries = discover.from_toc(frame(spark, [(TOC,)], "text string"), "http://h/7/", "N", wanted)
    asked = frame(spark, [(w,) for w in wanted], "full_type_name string")
    return discover.found_targets(asked, entries).join(entries.select(F.col("declaring_type_hint").alias("full_type_name"), "url"), "full_type_name", "left").select("full_type_name", "found", "url")


@query(expected([("http://h/7/a.htm",), ("http://h/7/b/c.htm",)], "url"))
def sitemap_entries(t, spark):
    """Locations of any XML name space, on the host and under the version; malformed XML has none."""
    maps = [("http://h/map.xml", "<x:s xmlns:x='y'><x:loc> /7/a.htm </x:loc><x:loc>http://h/7/b/c.htm</x:loc><x:loc>http://h/8/d.htm</x:loc><x:loc>http://i/7/e.htm</x:loc><x:loc/></x:s>"), ("http://h/bad.xml", "<s><loc>http://h/7/z.htm</loc>")]
    return discover.from_sitemap(frame(spark, maps, "url string, text string"), "h", "7").select("url")


@query(expected([("http://h/7/p.htm", "second", "root"), ("http://h/7/0a1b2c3d-4e.htm", "", "root:regex_guid")], "url, link_text, discovered_via"))
def anchor_entries(t, spark):
    """The last of equal anchors counts; page ids that stand in scripts are added if no anchor leads there."""
    html = "<a href=/7/p.htm>first</a><a href='http://h/7/p.htm'>second</a><a href=/8/q.htm>no</a><a>none</a><script>go('7/0a1b2c3d-4e.htm', \"/7/p.htm\")</script>"
    return discover.from_html(frame(spark, [("http://h/7/", html)], "url string, html string"), "root", "h", "7", "http://h/").select("url", "link_text", "discovered_via")


# descriptor sources

MAP = """using Alias = Some.Space.Real;
var descriptor = value switch
{
    // Base
    string text => new TextDescriptor(text),
    bool value => new BoolDescriptor(value),
    Alias value when value.Kind == 1 && Test(value, 2) => new RealDescriptor(value), // Trailing
    /* Ignored */
    //Objects
    Some.Other.Item => new ItemDescriptor(),
    null => new NullDescriptor(),
    _ => new AnyDescriptor(value)
};
"""
SOURCE = """
public sealed class RealDescriptor : Descriptor, IDescriptorResolver, IDescriptorExtension
{
    public ResolveSet Resolve(Document doc, string target, ParameterInfo[] parameters)
    {
        return target switch
        {
            nameof(Real.Plain) => Variants.Single(1),
            "Literal" when parameters.Length == 1 => Found(doc.Title),
            nameof(Real.Local) => ResolveLocal(),
#if NEWER
            nameof(Real.Group) => ResolveGroup,
#endif
            nameof(Some.Real.Many) => new Variants<int>(2).Add(1).Add(2), // "Not" => this
            _ => null
        };

        ResolveSet ResolveLocal() { if (ok) { go("}"); } return RevitApi.Document.All(); }
        IVariants ResolveGroup() { return Variants.Values<int>(3); }
    }

    public void RegisterExtensions(IExtensionManager<Real> manager)
    {
        manager.Register(nameof(RealExtensions.First), _ => 1);
        manager.Register("Second", x => { x.Name = nameof(Third); });
        other.Register(nameof(Fourth));
    }
}
"""


@query(expected([(0, "Real", "RealDescriptor", "Base"), (1, "Item", "ItemDescriptor", "Objects"), (2, "bool", "BoolDescriptor", "Base")], "k, type, descriptor, section"))
def descriptor_map_entries(t, spark):
    """Arms of a type with its value, or alone; others (string text, null, _) are no entries. A comment behind code is no heading."""
    rows = frame(spark, [(MAP,)], "content string").select(F.explode(udf(csharp.map_entries, "array<struct<target_type_short_name:string,descriptor_class:string,section:string>>")("content")).alias("x")).select("x.*")
    k = F.array_position(F.array(F.lit("Real"), F.lit("Item"), F.lit("bool")), F.col("target_type_short_name")).cast("int") - 1
    return rows.select(k.alias("k"), F.col("target_type_short_name").alias("type"), F.col("descriptor_class").alias("descriptor"), "section")


def _descriptors(spark):
    from docgraph import schemas

    rows = [(SOURCE,), ("class Empty : IDescriptorResolver, IDescriptorExtension { }",), ("// nothing",)]
    return frame(spark, rows, "content string").select(udf(csharp.descriptor, schemas.DESCRIPTOR)("content").alias("d")).select("d.*")


@query(expected([("Plain", "nameof", False, False), ("Literal", "string_literal", True, False), ("Local", "nameof", True, False), ("Group", "nameof", False, True), ("Many", "nameof", True, True)], "member_name, name_source, requires_document_context, has_multiple_variants"))
def descriptor_members(t, spark):
    """Each named arm is read to the next; the last one to the end of the method, with the local functions there."""
    return _descriptors(spark).select(F.explode("resolved_members").alias("m")).select("m.*")


@query(expected([("RealDescriptor", "First,Second,Third", ""), ("Empty", "", "a resolver without a known Resolve method;an extension without a known RegisterExtensions method"), ("<unknown>", "", "no class declaration")], "descriptor_class, added, notes"))
def descriptor_extensions(t, spark):
    return _descriptors(spark).select("descriptor_class", F.array_join("synthetic_extensions", ",").alias("added"), F.array_join("parser_notes", ";").alias("notes"))


# candidates, evidence and graphs

TYPES = [(1, "N.Door", "class", "Opening"), (2, "N.Opening", "class", "N.Element"), (3, "N.Element", "class", None), (4, "N.A", "class", "B"), (5, "N.B", "class", "A"), (6, "N.Swing", "struct", "System.ValueType"), (7, "N.Side", "enum", "int"), (8, "N.Kind", "class", "ElementType"), (9, "N.C", "class", "N.D"), (10, "N.D", "class", "N.C")]


@query(expected([("N.Door", "Opening>N.Element", "true"), ("N.Opening", "N.Element", "true"), ("N.Element", "", "true"), ("N.A", "B>A", "unknown"), ("N.B", "A>B", "unknown"), ("N.C", "N.D", "false"), ("N.D", "N.C", "false"), ("N.Swing", "System.ValueType", "false"), ("N.Side", "", "unknown"), ("N.Kind", "ElementType", "unknown")], "full_type_name, bases, is_element"))
def inheritance_chains(t, spark):
    """Bases upwards, as they are spelled; a chain ends before a name that would come again. Only one that is spelled in full
    is known to come round."""
    rows = frame(spark, TYPES, "ord long, full_type_name string, kind string, base_type string")
    return classify.chains(rows).select("full_type_name", F.array_join("chain", ">").alias("bases"), "is_element")


PARAMETER = "array<struct<name:string,type:string>>"
MEMBER = f"array<struct<name:string,kind:string,declaring_type:string,return_type:string,is_static:boolean,parameters:{PARAMETER}>>"


def _member(name, returns, *takes, by=None):
    return {"name": name, "kind": "method", "declaring_type": by, "return_type": returns, "is_static": False, "parameters": [{"name": "p", "type": x} for x in takes]}


@query(expected([
    (1, "signature_confirmed", "declared", "N.Door", ""), (2, "signature_confirmed", "inherited", "N.Base", ""), (3, "signature_mismatch", "declared", "N.Door", "no overload has this signature"), (4, "member_not_found", None, None, "member is on neither the type nor an ancestor"), (5, "member_not_found", None, None, "source type is not in the manifest"), (6, "signature_confirmed", "inherited", "N.Top", ""),
], "ord, status, scope, declared_by, note"))
def manifest_ancestor_members(t, spark):
    """Members on the type, then on its ancestors in order; of all overloads the first that agrees."""
    types = [
        ("N.Door", "Door", ["N.Base", "N.Top"], [_member("Open", "System.Int32"), _member("Open", "void", "System.String"), _member("Close", "System.Int32")]),
        ("N.Base", "Base", ["N.Top"], [_member("Close", "void"), _member("Lock", "System.Boolean", "int")]), ("N.Top", "Top", [], [_member("Name", "string", by="N.Top")]),
    ]
    edges = [(1, "N.Door", "Open", "void", ["string"]), (2, "N.Door", "Close", "void", []), (3, "N.Door", "Open", "double", []), (4, "N.Door", "Turn", "void", []), (5, "X.Gone", "Open", "void", []), (6, "N.Door", "Name", "String", [])]
    e = frame(spark, edges, "ord int, source_type string, member_name string, return_type string, parameter_types array<string>").withColumn("member_kind", F.lit("method"))
    found = corroborate.edge_results(e, frame(spark, types, f"full_type_name string, short string, inheritance_chain array<string>, members {MEMBER}"))
    return found.select("ord", F.col("dll_verified_status").alias("status"), F.col("dll_relationship_scope").alias("scope"), F.col("actual_declaring_type").alias("declared_by"), "note")


@query(expected([(0, True, True, "found"), (1, True, True, "found on an ancestor"), (2, True, False, "member found, no edge"), (3, False, False, "member not found")], "check_ord, member_found, edge_found, note"))
def known_edges_on_ancestors(t, spark):
    checks = frame(spark, [(0, "N.Door", "Width"), (1, "N.Door", "LevelId"), (2, "N.Door", "Name"), (3, "N.Door", "Gone")], "check_ord int, source_type string, member_name string")
    members = frame(spark, [("N.Door", "Width", 1), ("N.Base", "LevelId", 2), ("N.Top", "Name", 3)], "full_type_name string, member_name string, ord long")
    chains = frame(spark, [("N.Door", ["Base", "X.Top"])], "full_type_name string, chain array<string>")
    edges = frame(spark, [("N.Door", "Width", "SIZED", "N.W", 1), ("N.Base", "LevelId", "ON", "N.Level", 2)], "source_type string, member_name string, candidate_edge_type string, candidate_target_type string, ord long")
    return corroborate.known_edges(checks, members, chains, edges).select("check_ord", "member_found", "edge_found", "note")


@query(expected([("declared", 2, 500), ("inherited", 1, 250), ("none", 1, 250)], "value, n, permille"))
def evidence_histogram(t, spark):
    rows = frame(spark, [("declared",), ("declared",), ("inherited",), (None,)], "scope string")
    return corroborate.histogram(rows, "scope").select("value", F.col("n").cast("int").alias("n"), (F.col("percent") * 10).cast("int").alias("permille"))


FIELDS = [(t, m, k) for t, ms in (("kind", [("class", 2), ("enum", 1)]), ("total", [("types", 3), ("members", 3)]), ("unresolved", [("return_type", 1)]), ("by_reference", [("out", 1), ("ref", 1)]), ("void", [("methods", 1)])) for m, k in ms]


@query(expected(FIELDS, "what, value, n"))
def manifest_totals(t, spark):
    types = [{"full_type_name": "N.A", "kind": "class", "members": [_member("F", None, "out int", "ref N.B", "int"), _member("G", "<unresolved>")]}, {"full_type_name": "N.B", "kind": "class", "members": [_member("H", "int")]}, {"full_type_name": "N.E", "kind": "enum", "members": []}]
    rows = frame(spark, [(types,)], f"types array<struct<full_type_name:string,kind:string,members:{MEMBER}>>")
    return tables.manifest_summary(rows).withColumn("n", F.col("n").cast("int"))


def _types(spark):
    types = [{"full_type_name": "N.A", "inheritance_chain": ["N.Base", "N.Top"], "members": [_member("F", None, "out int", "ref N.B"), _member("F", "int"), _member("G", "int", "out int")]}, {"full_type_name": "N.B", "inheritance_chain": [], "members": []}]
    return frame(spark, [(types,)], f"types array<struct<full_type_name:string,inheritance_chain:array<string>,members:{MEMBER}>>")


@query(expected([(0, "N.A", "F", True, "N.Base -> N.Top", 2, "void (out int, ref N.B); int ()"), (1, "N.B", "F", True, "", 0, ""), (2, "N.C", "F", False, None, 0, "")], "place, full_type_name, member_name, type_found, chain, overloads, signatures"))
def manifest_tracked_facts(t, spark):
    return tables.tracked(_types(spark), [("N.A", "F"), ("N.B", "F"), ("N.C", "F")])


@query(expected([("out int", "N.A.F"), ("ref N.B", "N.A.F")], "type, member"))
def manifest_by_reference(t, spark):
    return tables.by_reference(_types(spark))


CLIQUES = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("e", "f"), ("f", "d"), ("g", "h")]


@query(expected([(n, 0) for n in "abc"] + [(n, 1) for n in "def"] + [(n, 2) for n in "gh"], "id, community_id"))
def community_local_moves(t, spark):
    """Two triangles with one edge between them, and a pair: numbered by size, then by smallest member."""
    nodes = frame(spark, [(n,) for n in "abcdefghi"], "id string")
    edges = frame(spark, [(k, *e) for k, e in enumerate(CLIQUES)], "ord long, source string, target string")
    return community.detect(nodes, edges).select("id", F.col("community_id").cast("int").alias("community_id"))


@query(expected([("a", "b", 2), ("b", "c", 1)], "a, b, weight"))
def projection_of_foreign_ends(t, spark):
    """Loops, nulls and ends that are no nodes are left out; both directions are one edge."""
    nodes = frame(spark, [("a",), ("b",), ("c",)], "id string")
    edges = frame(spark, [(1, "a", "b"), (2, "b", "a"), (3, "c", "c"), (4, "a", None), (5, "x", "a"), (6, "c", "b")], "ord long, source string, target string")
    return graph.projection(nodes, edges).select("a", "b", F.col("weight").cast("int").alias("weight"))


@query(expected([("Level", "ASSIGNED_TO_LEVEL", 0, 2), ("Element", "ASSIGNED_TO_LEVEL", 2, 0), ("Element", "TYPE_OF", 1, 1)], "role, edge_type, as_source, as_target"))
def role_map_ends(t, spark):
    nodes = frame(spark, [("N.Wall", "Wall", None, "element_subtype"), ("N.Level", "Level", None, "unknown"), ("N.Door", "Door", None, "element_subtype")], "id string, short_name string, base_type string, class_role string")
    edges = frame(spark, [(1, "N.Wall", "N.Level", "ASSIGNED_TO_LEVEL"), (2, "N.Door", "N.Level", "ASSIGNED_TO_LEVEL"), (3, "N.Door", "N.Wall", "TYPE_OF"), (4, "N.Door", "N.Gone", "TYPE_OF")], "ord long, source string, target string, edge_type string")
    rows = roles.with_roles(nodes, edges)
    ends = rows.select(F.col("source_role").alias("role"), "edge_type", F.lit(1).alias("s"), F.lit(0).alias("t")).union(rows.select("target_role", "edge_type", F.lit(0), F.lit(1)))
    return ends.groupBy("role", "edge_type").agg(F.sum("s").cast("int").alias("as_source"), F.sum("t").cast("int").alias("as_target"))


@query(expected([("a", 10, 25), ("a", 40, 50), ("b", 5, 25)], "run, elapsed, pages"))
def checkpoints_due(t, spark):
    """At each 25 pages, if 30 seconds have passed since the last one."""
    log = [("a", 10.0, 25), ("a", 20.0, 26), ("a", 30.0, 75), ("a", 40.0, 50), ("a", 60.0, 100), ("b", 5.0, 25), ("b", 6.0, 50)]
    due = progress.due(frame(spark, log, "run string, elapsed double, pages long"))
    return due.select("run", F.col("elapsed").cast("int").alias("elapsed"), F.col("pages").cast("int").alias("pages"))


@query(expected([("A", 3, "x"), ("B", 2, "y")], "key, count, rest"))
def pareto_shown(t, spark):
    """Clusters of at least two, the largest first; the others go."""
    rows = frame(spark, [("A", 3, "x"), ("B", 2, "y"), ("C", 1, "z")], "key string, count int, rest string").withColumn("first", F.col("key"))
    return pareto.shown(rows, 2, 2).select("key", "count", "rest")


# rules

@query("SELECT * FROM " + sql_values(EXPECTED, "member_name, candidate_edge_type, edge_confidence, candidate_target_type"))
def member_tree(t, spark):
    m = spark.createDataFrame([(i, *r) for i, r in enumerate(MEMBERS)], "ord long, name string, kind string, return_type string")
    m = m.withColumn("source_type", F.lit(f"{DB}.Owner")).withColumn("raw_signature", F.lit("")).withColumn("parameters", F.array().cast("array<struct<name:string,type:string>>")).withColumn("summary", F.lit("")).withColumn("remarks", F.lit("")).withColumn("source_url", F.lit(""))
    return classify.member_edges(m, F.col("bare").isin(V.KNOWN_REFERENCES + ["Owner"])).select("member_name", "candidate_edge_type", "edge_confidence", "candidate_target_type")


TYPE_NAMES = [
    ("ICollection(ElementId)", "ICollection<ElementId>"), ("System.Collections.Generic.ICollection`1[[Autodesk.Revit.DB.ElementId, RevitAPI, Version=1.0]]", "ICollection<ElementId>"), ("System.Collections.Generic.ICollection`1[Autodesk.Revit.DB.ElementId]", "ICollection<ElementId>"),
    ("ICollection < ElementId >", "ICollection<ElementId>"), ("void", ""), ("System.Void", ""), ("Outer+Inner", "Inner"), ("Autodesk.Revit.DB.Outer+Inner", "Inner"), ("bool", "Boolean"), ("System.Int32", "Int32"), ("int", "Int32"), ("float", "Single"),
    ("out ModelCurveArray", "out ModelCurveArray"), ("IDictionary < K , V >", "IDictionary<K,V>"), ("  ElementId ", "ElementId"), ("string", "String"), ("Dictionary`2[A.K,B.V]", "Dictionary<K,V>"), (None, ""),
]


@query("SELECT * FROM " + sql_values(TYPE_NAMES, "spelled, canonical"))
def signature_normalize(t, spark):
    return spark.createDataFrame([(a,) for a, _ in TYPE_NAMES], "spelled string").withColumn("canonical", typenames.canonical(F.col("spelled")))
