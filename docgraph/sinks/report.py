"""Reports from small aggregates: Markdown with bounded sections, HTML with embedded JSON. Made on the driver."""

from __future__ import annotations

import html as html_
import json
import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..operators.corroborate import histogram
from ..operators.graph import Graph, core, metadata
from ..operators.pareto import breakdown, by_confidence, totals


def table(df: DataFrame, most: int = 25) -> str:
    """A Markdown table of the first rows; cells are escaped."""
    rows = df.limit(most + 1).collect()
    cell = lambda v: "" if v is None else f"{v:.1f}" if isinstance(v, float) else f"{v:,}" if isinstance(v, int) and not isinstance(v, bool) else str(v).replace("|", "\\|").replace("\n", " ")
    lines = ["| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
    lines += ["| " + " | ".join(map(cell, r)) + " |" for r in rows[:most]]
    return "\n".join(lines + (["", "and more"] if len(rows) > most else []))


def section(title: str, body: str) -> str:
    return f"## {title}\n\n{body}\n"


def replaced(text: str | None, title: str, body: str) -> str | None:
    """The text with the section of a title (any number before it) replaced in place, or put at the end.

    No-op for an empty body; None stays None. Doing it twice is like doing it once.
    """
    if text is None or not body.strip():
        return text
    m = re.search(rf"^## (?:\d+\. )?{re.escape(title)}\n.*?(?=^## |\Z)", text, re.M | re.S)
    new = section(title, body.strip())
    if m:
        head = m[0].split("\n", 1)[0]
        new = f"{head}\n\n{body.strip()}\n"
        rest = text[m.end() :]
        return text[: m.start()] + new + ("\n" if rest else "") + rest
    return text.rstrip("\n") + "\n\n" + new


def bullets(items: list[str]) -> str:
    return "\n".join(f"- {x}" for x in items) or "- none"


def summary(pages: DataFrame, nodes: DataFrame, edges: DataFrame, graph: Graph, communities: DataFrame | None = None, unknown_top: int = 15, scope: dict[str, object] | None = None, limits: list[str] = (), next_steps: list[str] = ()) -> str:
    """The summary of a run, with numbered sections. scope: what was asked for, by name."""
    unknown = edges.where("candidate_edge_type like 'UNKNOWN%'")
    enums = pages.where("kind = 'enum'").agg(F.count("*").alias("enums"), F.coalesce(F.sum(F.size("enum_members")), F.lit(0)).alias("members"))
    parts = {
        "Scope": bullets([f"{k}: {v}" for k, v in (scope or {}).items() if v is not None]),
        "Pages": table(pages.groupBy("kind").count().orderBy("kind")),
        "Nodes": table(nodes.groupBy("class_role").count().orderBy("class_role")),
        "Edges": table(edges.groupBy("member_kind").count().orderBy("member_kind")),
        "Unknown relations": table(totals(edges)) + "\n\n" + table(breakdown(unknown, "candidate_target_type", unknown_top)),
        "Most certain edges": table(by_confidence(edges).select("source_type", "member_name", "candidate_edge_type", "candidate_target_type", "edge_confidence")),
        "Least certain edges": table(by_confidence(edges, certain=False).select("source_type", "member_name", "candidate_edge_type", "candidate_target_type", "edge_confidence")),
        "Enum members": table(enums),
        "Parser notes": table(pages.where("size(parser_notes) > 0").groupBy("kind").count().orderBy("kind")),
        "Graph": table(metadata(graph).orderBy("axis", "value"), 100),
        "Core": table(metadata(core(graph)).where("axis in ('nodes', 'edges')").orderBy("axis")),
    }
    if communities is not None:
        parts["Communities"] = table(communities.select("community_id", "label", "size").orderBy("community_id"), 10)
    parts |= {"Limitations": bullets(list(limits)), "Next steps": bullets(list(next_steps))}
    return "# Summary\n\n" + "\n".join(section(f"{k}. {t}", b) for k, (t, b) in enumerate(parts.items(), 1))


def validation(targets: DataFrame, known: DataFrame, pages: DataFrame, nodes: DataFrame, edges: DataFrame, failed: list[str] = (), notes: list[str] = (), least_targets: int = 10, least_checks: int = 5) -> str:
    """What a targeted run found, with three kinds of success apart: were pages found, was data extracted, is a relation sure."""
    t = targets.agg(F.count("*").alias("n"), F.count_if("found").alias("found"), F.count_if("parsed").alias("parsed")).first()
    k = known.agg(F.count("*").alias("n"), F.count_if("member_found").alias("found"), F.count_if("edge_found").alias("edges")).first()
    p = pages.agg(F.count("*").alias("n"), F.count_if(F.size("parser_notes") > 0).alias("noted")).first()
    kinds = {r.member_kind: r["count"] for r in edges.groupBy("member_kind").count().collect()}
    order = R.rank(F.col("edge_confidence"))
    done = lambda ok, text: f"[{'x' if ok else ' '}] {text}"
    parts = {
        "Scope": bullets([f"targets: {t.n}", f"expected edges: {k.n}"]),
        "Coverage": bullets([f"{t.found} of {t.n} targets found in the index", f"{len(failed)} pages failed", *notes]),
        "Parser": bullets([f"{t.parsed} of {t.n} targets parsed", f"{p.n} pages parsed, {p.noted} of them with a note", f"{k.found} of {k.n} expected members found"]),
        "Confidence": bullets([f"{kinds.get('property', 0)} candidates of properties, {kinds.get('method', 0)} of methods", f"{k.edges} of {k.n} expected edges produced"]) + "\n\n" + table(edges.groupBy("edge_confidence").count().orderBy(order)) + "\n\n" + table(nodes.groupBy("class_role").count().orderBy("class_role")),
        "Targets": table(targets, 100),
        "Expected edges": table(known, 100),
        "Checklist": bullets([done(t.found >= least_targets, f"at least {least_targets} of {t.n} targets found ({t.found})"), done(k.n >= least_checks, f"at least {least_checks} expected edges reported ({k.n})"), done(kinds.get("property") and kinds.get("method"), "candidates of properties and of methods"), done(True, "coverage, parser and confidence are told apart")]),
        "Limitations": bullets(["a target that was not found has no data in this run", "candidates come from documentation alone"]),
    }
    return "# Validation\n\n" + "\n".join(section(f"{n}. {title}", body) for n, (title, body) in enumerate(parts.items(), 1))


def corroboration(results: DataFrame, column: str, top: int = 10, scope: str | None = None, notes: list[str] = ()) -> str:
    """Counts and shares of each status (and scope), and the first rows of each status."""
    parts = [bullets(list(notes))] if notes else []
    parts += [table(histogram(results, c).orderBy("value")) for c in filter(None, (column, scope))]
    for value in [r[0] for r in results.select(column).distinct().orderBy(column).collect()]:
        rows = results.where(F.col(column).eqNullSafe(F.lit(value))).select("source_type", "member_name", *([scope] if scope else []))
        parts.append(f"{column} {value}:\n\n" + table(rows.orderBy("source_type", "member_name"), top))
    return "\n\n".join(parts)


def embedded(template: str, mark: str, data: object) -> str:
    """The template with data as JSON for its mark; '</' is escaped so that no tag can end a script."""
    return template.replace(mark, json.dumps(data, ensure_ascii=False).replace("</", "<\\/"))


GRAPH_PAGE = """<!doctype html><meta charset=utf-8><title>Graph</title>
<input id=q placeholder=Search><select id=tier></select><select id=role></select><span id=n></span><ul id=list></ul><pre id=inspector></pre>
<script>
const g = __DATA__, $ = id => document.getElementById(id), degree = {}
for (const e of g.edges) { degree[e.source] = (degree[e.source] || 0) + 1; if (e.target && e.target !== e.source) degree[e.target] = (degree[e.target] || 0) + 1 }
const fill = (id, all, name) => $(id).replaceChildren(...["all " + name, ...new Set(all)].map(x => new Option(x, x)))
fill("tier", g.edges.map(e => e.confidence_tier).sort(), "tiers"); fill("role", g.nodes.map(n => n.class_role || "unknown").sort(), "roles")
const edges = () => g.edges.filter(e => $("tier").selectedIndex < 1 || e.confidence_tier === $("tier").value)
function inspect(id) { $("inspector").textContent = id + "\\n" + edges().filter(e => e.source === id || e.target === id).map(e => e.source + " " + e.edge_type + " " + (e.target || "?") + " (" + e.confidence_tier + ")").join("\\n") }
function show() {
  const ends = new Set(edges().flatMap(e => [e.source, e.target])), text = $("q").value.toLowerCase()
  const own = g.nodes.filter(n => n.id.toLowerCase().includes(text) && ($("role").selectedIndex < 1 || (n.class_role || "unknown") === $("role").value) && ($("tier").selectedIndex < 1 || ends.has(n.id)))
  $("n").textContent = own.length + " nodes"
  $("list").replaceChildren(...own.map(n => { const x = document.createElement("li"); x.textContent = n.id + " (" + (degree[n.id] || 0) + ")"; x.onclick = () => inspect(n.id); return x }))
}
for (const id of ["q", "tier", "role"]) $(id).oninput = show
show()
</script>"""


def graph_page(g: Graph) -> str:
    """A page with the graph's projected columns: search, filters by tier and role, each node's degree (a loop counts once), and
    the edges of the node that is clicked."""
    rows = lambda df: [r.asDict() for r in df.toLocalIterator()]
    return embedded(GRAPH_PAGE, "__DATA__", {"nodes": rows(g.nodes.select("id", "short_name", "external", "class_role")), "edges": rows(g.edges.select("source", "target", "edge_type", "confidence_tier"))})


def heatmap(cells: DataFrame, role: str = "source_role", relation: str = "edge_type") -> str:
    """An HTML table of weights by role and relation, in the order of the rows; shades go by the square root of the weight."""
    data = cells.collect()
    rows, columns = [*dict.fromkeys(r[role] for r in data)], [*dict.fromkeys(r[relation] for r in data)]
    weight, most = {(r[role], r[relation]): r["weight"] for r in data}, max((r["weight"] for r in data), default=1)
    cell = lambda n: f'<td style="background:rgba(74,120,176,{math.sqrt(n / most):.2f})">{n:,}</td>' if n else "<td></td>"
    head = "".join(f"<th>{html_.escape(c)}</th>" for c in columns)
    body = "".join(f"<tr><th>{html_.escape(r)}</th>" + "".join(cell(weight.get((r, c), 0)) for c in columns) + "</tr>" for r in rows)
    return f"<table><tr><th></th>{head}</tr>{body}</table>"


def role_page(made: dict[str, DataFrame]) -> str:
    """The relationship map as one page: flow chart, heatmap, and the first edges behind each triple to unfold."""
    told = made["disclosed"].first()
    behind: dict[tuple, list[str]] = {}
    for r in made["drilldown"].orderBy("source_role", "edge_type", "target_role", "place").toLocalIterator():
        behind.setdefault((r.source_role, r.edge_type, r.target_role), []).append(f"{r.source}.{r.member_name} → {r.target}")
    unfold = "".join(f"<details><summary>{html_.escape(' → '.join(k))}</summary><ul>{''.join(f'<li>{html_.escape(x)}</li>' for x in v)}</ul></details>" for k, v in behind.items())
    return f"<!doctype html><meta charset=utf-8><title>Roles</title><p>{told.included:,} of {told.total:,} edges are shown</p>{flow_chart(made['triples'])}{heatmap(made['heatmap'])}{unfold}"


def flow_chart(triples: DataFrame, width: int = 900, row: int = 22) -> str:
    """Triples as an SVG of curves from source to target roles; widths and opacities go by the square root of the weight."""
    data = triples.collect()
    left, right = ([*dict.fromkeys(r[c] for r in data)] for c in ("source_role", "target_role"))
    most = max((r.weight for r in data), default=1)
    at = lambda names, n: 30 + row * names.index(n)
    out = [f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{60 + row * max(len(left), len(right), 1)}">']
    for r in data:
        a, b, s = at(left, r.source_role), at(right, r.target_role), math.sqrt(r.weight / most)
        out.append(f'<path d="M200 {a} C{width // 2} {a} {width // 2} {b} {width - 200} {b}" fill="none" stroke="#4a78b0" stroke-width="{1 + 12 * s:.1f}" opacity="{0.15 + 0.6 * s:.2f}"><title>{html_.escape(r.edge_type)} {r.weight:,}</title></path>')
    out += [f'<text x="190" y="{at(left, n) + 4}" text-anchor="end">{html_.escape(n)}</text>' for n in left] + [f'<text x="{width - 190}" y="{at(right, n) + 4}">{html_.escape(n)}</text>' for n in right]
    return "".join(out) + "</svg>"
