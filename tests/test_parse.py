import pytest
from pyspark.sql import functions as F

from docgraph.functions import html as H
from docgraph.functions.text import closing, tokens, top_level_parts, without_trailing_group
from docgraph.operators import classify, graph
from docgraph.operators import parse as P

SPACE = '<script>var d = {"namespace": "Autodesk.Revit.DB"}</script>'
CLASS = SPACE + '<h1 id=PageHeader>Wall Class</h1><pre class="typeSignature">public class Wall : HostObject, IDisposable</pre><div class=remarks>hosted by</div><table class="members"><tr><td><a href="w.htm">Width</a></td><td>width</td></tr><tr data="public;inherited;x"><td><img></td><td><a href="id.htm">Id</a></td><td>The id (Inherited from Element.)</td></tr><tr data="inherited"><td></td><td><a href="q.htm">Q</a></td><td>no owner</td></tr></table><table id=bottomTable><tr><td><a href="m.htm">Members</a></td></tr></table>'
ENUM = SPACE + "<h1>Kind Enumeration</h1><table class=members><tr><td>Member name</td><td>Value</td><td>x</td></tr><tr><td>A</td><td>-2</td><td>first</td></tr><tr><td>B</td><td>n/a</td><td>second</td></tr><tr><td>C</td><td>third</td></tr></table>"
INDEX = SPACE + '<h4 id=api-title>Wall Members</h4><div id=mainBody><h1 class=heading>Methods</h1><table class=members><tr><td></td><td><a href=f.htm>Flip</a></td><td>x</td></tr></table><span class=collapsibleRegionTitle><img> Properties</span><div><table id=memberList><tr><td></td><td><a href=w.htm>Width</a></td><td>x</td></tr><tr><td></td><td>Equals</td><td>no link</td></tr></table></div></div>'


def test_type_page():
    r = P.parse_page("http://h/2024/wall.htm", CLASS, "2024", None)
    assert (r["kind"], r["full_type_name"], r["base_type"], r["implemented_interfaces"]) == ("class", "Autodesk.Revit.DB.Wall", "HostObject", ["IDisposable"])
    assert [(m["name"], m["return_type"]) for m in r["members"]] == [("Width", None), ("Id", None), ("Q", None)]
    assert [(x["name"], x["declaring_type_hint"]) for x in r["links"]] == [("Width", None), ("Id", "Autodesk.Revit.DB.Element")]
    assert r["members_page"] == "http://h/2024/m.htm"


def test_enum_page_keeps_numbers_as_text():
    r = P.parse_page("u", ENUM, "2024", None)
    assert [(m["member_name"], m["numeric_value"]) for m in r["enum_members"]] == [("A", "-2"), ("B", None), ("C", None)]


def test_members_index_carries_headings():
    r = P.parse_page("http://h/2024/m.htm", INDEX, "2024", None)
    assert [(x["name"], x["member_kind"]) for x in r["links"]] == [("Flip", "method"), ("Width", "property")]


@pytest.mark.parametrize(
    "title, syntax, want",
    [
        ("Wall.Flip Method (Document, ICollection(ElementId))", "public void Flip ( Document d, IDictionary&lt;A, B&gt; m )", ("Flip", "method", "void", ["Document", "IDictionary<A, B>"])),
        ("Wall Constructor", "public Wall ( int x )", ("Wall", "method", None, ["int"])),
        ("Width Property", "public double Width { get; }", ("Width", "property", "double", [])),
    ],
)
def test_member_page(title, syntax, want):
    m = P.parse_page("u", f"{SPACE}<h1>{title}</h1><pre class=code>{syntax}</pre>", "2024", "N.Wall")["members"][0]
    assert (m["name"], m["kind"], m["return_type"], [p["type"] for p in m["parameters"]]) == want


@pytest.mark.parametrize("html", [None, "", "<p><b>x</i></p></div>", "<h1>Odd</h1>"])
def test_odd_pages(html):
    assert P.parse_page("u", html, None, None)["kind"] == "unknown"


def test_html_tree():
    t = H.tree("<div id=a class='x y'><p>1<p>2</div><br>3</span>")
    assert t.select("div.x.y > p:first-of-type")[0].text() == "12"
    assert t.select_first(["div#b", "#a p"]).name == "p" and t.text("|") == "1|2|3"


def test_brackets():
    assert without_trailing_group("F Method (A(B), C)") == "F Method" and without_trailing_group("F )x)") == "F )x)"
    assert top_level_parts("a<b,c>,d[e,f],g>") == ["a<b,c>", "d[e,f]", "g>"]
    assert top_level_parts("a>,b") == ["a>", "b"] and top_level_parts("") == [] and top_level_parts("a,") == ["a"]


def test_tokens():
    ts = tokens('x{ /* } */ a("}", \'}\') // }\n#if }\n@"c""}" => $"{y}" }z')
    assert [t.text for t in ts if t.kind == "string"] == ['"}"', '@"c""}"', '$"{y}"'] and [t.kind for t in ts].count("comment") == 2
    assert ts[closing(ts, 1, "{}")].end == ts[-1].at and closing(tokens("{a"), 0, "{}") == 2 and "=>" in [t.text for t in ts]


@pytest.mark.parametrize("depth", [1, 5000])
def test_deep_pages(depth):
    page = P.parse_page("u", SPACE + "<h1>Wall Class</h1>" + "<p>" * depth + "deep", "1", None)
    assert page["kind"] == "class" and H.tree("<p>" * depth + "deep").text() == "deep" and len(H.tree("<b>" * depth).all("b")) == depth


@pytest.mark.parametrize(
    "syntax, want",
    [
        ("public class Wall : HostObject, IDisposable { }", ("HostObject", ["IDisposable"])), ("public class Foo<T> : Bar", (None, [])), ("public enum A : int", ("int", [])), ("interface X : IFoo, IBar", (None, ["IFoo", "IBar"])),
    ],
)
def test_bases(syntax, want):
    assert P.bases(syntax)[:2] == want


@pytest.mark.parametrize(
    "syntax, want",
    [
        ("public IList < ElementId > GetX ( )", ("IList < ElementId >", [])), ("public int[] F(ref A.B x)", ("int[]", ["ref A.B"])), ("int? X {", ("int?", [])), ("public static A.B.C<D, E> Make(IDictionary<F, G> m, H[,] n)", ("A.B.C<D, E>", ["IDictionary<F, G>", "H[,]"])),
        ("public Element this[int x] { get; }", (None, [])), ("void F(int a", (None, [])), ("", (None, [])),
    ],
)
def test_signatures(syntax, want):
    returns, parameters, _ = P.signature(syntax)
    assert (returns, [p["type"] for p in parameters]) == want


def pages(spark, rows):
    return P.parse(spark.createDataFrame(rows, "ord long, url string, html string, version string, hint string"), F.col("hint"))


def test_candidates_and_graph(spark):
    member = SPACE + "<h1>Wall.LevelId Property</h1><pre class=code>public ElementId LevelId {get;}</pre>"
    view = SPACE + "<h1>View Class</h1><pre class=code>public class View : Element</pre>"
    host = SPACE + "<h1>HostObject Class</h1><pre class=code>public class HostObject : Element</pre>"
    p = pages(spark, [(1, "a", CLASS, "1", None), (2, "b", member, "1", "Autodesk.Revit.DB.Wall"), (3, "c", view, "1", None), (4, "d", host, "1", None), (5, "e", ENUM, "1", None)]).cache()
    nodes = {r.short_name: r for r in classify.nodes(p).collect()}
    assert nodes["Wall"].inheritance_chain == ["HostObject", "Element"] and nodes["Wall"].is_element_candidate == "true"
    assert nodes["Kind"].class_role == "enum" and nodes["Kind"].is_element_candidate == "false" and nodes["View"].class_role == "element_subtype"
    edges = classify.edges(p)
    e = edges.collect()
    assert [(x.source_type, x.candidate_edge_type, x.candidate_target_type) for x in e] == [("Autodesk.Revit.DB.Wall", "ASSIGNED_TO_LEVEL", "Autodesk.Revit.DB.Level")]
    g = graph.build(classify.nodes(p), edges)
    assert {r.id for r in g.nodes.where("external").collect()} == {"Autodesk.Revit.DB.Level"}
    assert {r.id for r in graph.core(g).nodes.collect()} == {"Autodesk.Revit.DB.Wall", "Autodesk.Revit.DB.Level"}


def test_chain_with_cycle(spark):
    rows = spark.createDataFrame([(1, "N.A", "class", "B"), (2, "N.B", "class", "C"), (3, "N.C", "class", "A"), (4, "N.D", "struct", "ValueType")], "ord long, full_type_name string, kind string, base_type string")
    got = {r.full_type_name: (len(r.chain), r.is_element) for r in classify.chains(rows).collect()}
    assert got["N.D"] == (1, "false") and all(got[f"N.{x}"] == (3, "unknown") for x in "ABC")
    full = spark.createDataFrame([(1, "N.A", "class", "N.B"), (2, "N.B", "class", "N.A"), (3, "N.Element", "class", None), (4, "N.T", "class", "ElementType")], "ord long, full_type_name string, kind string, base_type string")
    assert {r.full_type_name: (r.chain, r.is_element) for r in classify.chains(full).collect()} == {"N.A": (["N.B"], "false"), "N.B": (["N.A"], "false"), "N.Element": ([], "true"), "N.T": (["ElementType"], "unknown")}


def test_chains_of_any_length(spark):
    n = 150
    rows = [(k, f"N.C{k}", "class", f"C{k - 1}" if k else "System.Object") for k in range(n)] + [(n + k, f"N.L{k}", "class", f"L{(k + 1) % 70}") for k in range(70)] + [(n + 70, "N.Own", "class", "N.Own"), (n + 71, None, "class", None)]
    got = {r.full_type_name: r for r in classify.chains(spark.createDataFrame(rows, "ord long, full_type_name string, kind string, base_type string")).collect()}
    assert len(got) == len(rows) and all(got[f"N.C{k}"].chain == [*(f"C{j}" for j in range(k - 1, -1, -1)), "System.Object"] and got[f"N.C{k}"].is_element == "false" for k in range(n))
    assert all(len(got[f"N.L{k}"].chain) == 70 and got[f"N.L{k}"].is_element == "unknown" for k in range(70)) and got["N.Own"].chain == [] == got[None].chain
