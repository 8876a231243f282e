import json

import pytest

from docgraph import jobs
from docgraph.sinks import publish
from docgraph.streaming import crawl

SPACE = '<script>"namespace": "Autodesk.Revit.DB"</script>'
PAGES = [
    (1, "http://h/1/w.htm", SPACE + "<h1>Wall Class</h1><pre class=code>public class Wall : Element</pre><table id=bottomTable><tr><td><a href=m.htm>Members</a></td></tr></table>", None),
    (2, "http://h/1/m.htm", SPACE + "<h1>Wall Members</h1><h1 class=heading>Properties</h1><table class=members><tr><td></td><td><a href=l.htm>LevelId</a></td><td>x</td></tr></table>", None),
    (3, "http://h/1/l.htm", SPACE + "<h1>Wall.LevelId Property</h1><pre class=code>public ElementId LevelId { get; }</pre>", "Autodesk.Revit.DB.Wall"),
    (4, "http://h/1/e.htm", SPACE + "<h1>Level Class</h1><pre class=code>public class Level : Element</pre>", None),
    (5, "http://h/1/k.htm", SPACE + "<h1>Kind Enumeration</h1><table class=members><tr><td>A</td><td>1</td><td>x</td></tr></table>", None),
]


def test_lifecycle(spark, tmp_path):
    out = str(tmp_path / "out")
    pages = spark.createDataFrame([(o, u, h, "1", t) for o, u, h, t in PAGES], "ord long, url string, html string, version string, hint string")
    g = jobs.full(spark, pages, out)
    assert {r.id: r.community_id for r in g.nodes.collect()} == {"Autodesk.Revit.DB.Wall": 0, "Autodesk.Revit.DB.Level": 0, "Autodesk.Revit.DB.Kind": None}
    at = lambda name: publish.path(spark, out, name)
    told = lambda name: open(at(name), encoding="utf-8").read()
    summary = told("summary.md")
    counts = json.loads(told("metrics.json"))
    assert (counts["pages"]["rows"], counts["pages"]["kind=class"], counts["pages"]["kind=enum"], counts["pages"]["kind=*"]) == (5, 2, 1, 0)
    assert (counts["edges"]["rows"], counts["edges"]["member_kind=property"], counts["edges"]["member_kind=*"]) == (1, 1, 0)
    assert "ASSIGNED_TO_LEVEL" in summary and "## 10. Graph" in summary and "## 14. Next steps" in summary and "| 1 | 1 |" in summary
    (tmp_path / "m.json").write_text(json.dumps({"types": [{"full_type_name": "Autodesk.Revit.DB.Wall", "members": [{"name": "LevelId", "kind": "property", "return_type": "Autodesk.Revit.DB.ElementId", "parameters": []}]}]}))
    jobs.manifest(spark, out, str(tmp_path / "m.json"))
    (tmp_path / "r.json").write_text(json.dumps({"revitlookup_tag": "1", "descriptor_map": [{"target_type_short_name": "Wall", "descriptor_class": "D", "section": "S"}], "descriptors": [{"descriptor_class": "D", "resolved_members": [{"member_name": "LevelId", "name_source": "nameof", "requires_document_context": True, "has_multiple_variants": False}], "synthetic_extensions": [], "parser_notes": []}]}))
    jobs.descriptors(spark, out, str(tmp_path / "r.json"))
    (e,) = spark.read.parquet(at("graph_edges.parquet")).collect()
    assert (e.dll_verified_status, e.dll_relationship_scope, e.lookup_referenced, e.lookup_requires_document_context) == ("signature_confirmed", "declared", True, True)
    again = told("summary.md")
    assert again.count("Compiled manifest") == again.count("Descriptor sources") == 1
    assert "| signature_confirmed | 1 | 100.0 |" in again and "| declared | 1 | 100.0 |" in again
    assert {r.id: r.community_id for r in spark.read.json(at("graph_core/nodes")).collect()} == {"Autodesk.Revit.DB.Wall": 0, "Autodesk.Revit.DB.Level": 0} and spark.read.json(at("graph/nodes")).count() == 3
    page = told("roles.html")
    assert "1 of 1 edges are shown" in page and "<details>" in page and "Autodesk.Revit.DB.Wall.LevelId" in page
    jobs.targeted(spark, pages, out, ["Autodesk.Revit.DB.Wall", "Autodesk.Revit.DB.Gone"], [("Autodesk.Revit.DB.Wall", "LevelId")])
    checked = told("validation.md")
    assert "ASSIGNED_TO_LEVEL" in checked and "1 of 2 targets found" in checked and "[ ] at least 10 of 2 targets found (1)" in checked and "1 of 1 expected edges produced" in checked
    jobs.main(["pareto", "--out", out])


class Fake:
    def __init__(self):
        self.now = 0.0

    def clock(self):
        self.now += 40
        return self.now

    def fetch(self, url):
        return dict((u, h) for _, u, h, _ in PAGES)[url]


def test_crawl():
    said, told = [], []
    got = crawl.fetch_all(Fake(), [{"url": "http://h/1/w.htm", "declaring_type_hint": None}, {"url": "http://h/1/gone.htm"}], "1", lambda rows, final: said.append((final, [(r[1], r[4]) for r in rows])), every=2, say=told.append)
    assert [(x["done"], x["queued"], x["uncached"], x["failed"]) for x in told] == [(4, 0, 0, 1)] and told[0]["overall_rate"] > 0
    assert got["visited"] == ["http://h/1/w.htm", "http://h/1/gone.htm", "http://h/1/m.htm", "http://h/1/l.htm"] and [u for u, _ in got["failed"]] == ["http://h/1/gone.htm"]
    assert said[-1][0] and [x for _, rows in said for x in rows][-1] == ("http://h/1/l.htm", "Autodesk.Revit.DB.Wall")


def write(spark, run, name, value):
    spark.createDataFrame([(value,)], "v string").write.parquet(run.new(name))


def read(spark, out, names=("nodes", "edges", "graph")):
    return [spark.read.parquet(publish.path(spark, out, n)).first().v for n in names]


def test_a_failure_between_any_two_writes_leaves_the_old_run(spark, tmp_path):
    out = str(tmp_path / "out")
    with publish.run(spark, out) as r:
        for n in ("nodes", "edges", "graph"):
            write(spark, r, n, "old")
    for k in range(4):
        with pytest.raises(OSError), publish.run(spark, out) as r:
            for n in ("nodes", "edges", "graph")[:k]:
                write(spark, r, n, f"new{k}")
            raise OSError("lost")
        assert read(spark, out) == ["old"] * 3 and publish.published(spark, out)[0] == 1
    with publish.run(spark, out) as r:
        with publish.run(spark, r) as inner:  # a job within a job
            write(spark, inner, "edges", "between")
        assert read(spark, out) == ["old"] * 3 and spark.read.parquet(r.find("nodes")).first().v == "old"
        write(spark, r, "edges", "new")
    assert read(spark, out) == ["old", "new", "old"]
    assert len(publish.vacuum(spark, out, keep=1)) == 3 and read(spark, out) == ["old", "new", "old"]  # the three that had written


def test_two_runs_at_once_and_a_version_that_was_cut_off(spark, tmp_path):
    out = str(tmp_path / "out")
    first, second = publish.Run(spark, out), publish.Run(spark, out)
    write(spark, first, "nodes", "first")
    write(spark, second, "nodes", "second")
    first.commit()
    with pytest.raises(RuntimeError):
        second.commit()
    (tmp_path / "out" / "published" / "00000002.json").write_text('{"names": {"nod')
    assert read(spark, out, ["nodes"]) == ["first"]
    with publish.run(spark, out) as r:
        write(spark, r, "nodes", "third")
    assert read(spark, out, ["nodes"]) == ["third"] and publish.published(spark, out)[0] == 3
    assert publish.path(spark, out, "none") is None
