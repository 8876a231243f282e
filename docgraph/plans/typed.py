"""Queries over rules, candidates, graphs and their aggregates, on the relational tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import vocabulary as V
from ..operators import classify, communities, community, corroborate, graph, pareto, roles
from ..operators.lineage import cut, scratch
from ..operators.resolve import two_pass
from ..sinks import files
from .registry import query, sql_keyword, sql_values

_NAMES = "SELECT p_partkey, p_name, {r} AS r FROM part"
_RULES = sql_values([(i, e, h) for i, (_, _, e, h) in enumerate(V.KEYWORDS)], "r, edge_type, target_hint")


@query(f"SELECT p_partkey, edge_type, target_hint FROM (SELECT p_partkey, {sql_keyword('n')} AS r FROM (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'Get' || p_name || 'Level' WHEN 1 THEN 'GetAll' || p_name WHEN 2 THEN 'HostedRoom' WHEN 3 THEN 'SubSchema' WHEN 4 THEN p_name || 'SketchId' WHEN 5 THEN 'voltage' ELSE p_name END AS n FROM part)) x LEFT JOIN {_RULES} USING (r)")
def keyword_first_match(t, spark):
    k, n = F.col("p_partkey") % 7, F.col("p_name")
    name = F.when(k == 0, F.concat(F.lit("Get"), n, F.lit("Level"))).when(k == 1, F.concat(F.lit("GetAll"), n)).when(k == 2, "HostedRoom").when(k == 3, "SubSchema").when(k == 4, F.concat(n, F.lit("SketchId"))).when(k == 5, "voltage").otherwise(n)
    return t("part").select("p_partkey", R.keyword(name).alias("k")).select("p_partkey", "k.edge_type", "k.target_hint")


_CONF = "CASE " + " ".join(f"WHEN e % 7 = {i} THEN '{c}'" for i, c in enumerate(V.CONFIDENCE_ORDER)) + " END"
_EDGE = "CASE WHEN e % 5 = 0 THEN 'UNKNOWN_DB_OBJECT_REFERENCE' WHEN e % 5 = 1 THEN 'UNKNOWN_ELEMENTID_REFERENCE' WHEN e % 5 = 2 THEN 'USES_MATERIAL' WHEN e % 5 = 3 THEN 'HOSTED_BY' ELSE 'REFERENCES' END"
#: Candidate edges made of order lines: part -> supplier with cycling labels.
_CAND = f"SELECT ord, source_type, member_name, candidate_target_type, {_EDGE} AS candidate_edge_type, {_CONF} AS edge_confidence, e % 3 = 0 AS referenced, CASE WHEN e % 4 = 0 THEN 'member_not_found' END AS verified FROM (SELECT l_orderkey * 10 + l_linenumber AS ord, l_orderkey + l_linenumber AS e, 'P' || l_partkey AS source_type, 'Get' || l_returnflag || 'Id' AS member_name, 'S.S' || l_suppkey AS candidate_target_type FROM lineitem)"


def _candidates(t):
    e = F.col("l_orderkey") + F.col("l_linenumber")
    kinds = ["UNKNOWN_DB_OBJECT_REFERENCE", "UNKNOWN_ELEMENTID_REFERENCE", "USES_MATERIAL", "HOSTED_BY", "REFERENCES"]
    return t("lineitem").select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), F.concat(F.lit("P"), "l_partkey").alias("source_type"), F.concat(F.lit("Get"), "l_returnflag", F.lit("Id")).alias("member_name"), F.concat(F.lit("S.S"), "l_suppkey").alias("candidate_target_type"),
        F.element_at(F.array(*map(F.lit, kinds)), (e % 5 + 1).cast("int")).alias("candidate_edge_type"), F.element_at(F.array(*map(F.lit, V.CONFIDENCE_ORDER)), (e % 7 + 1).cast("int")).alias("edge_confidence"),
        (e % 3 == 0).alias("lookup_referenced"), F.when(e % 4 == 0, "member_not_found").alias("dll_verified_status"),
    )


_TIER = f"CASE WHEN edge_confidence = 'needs_runtime_validation' THEN 'needs_validation' WHEN candidate_edge_type LIKE 'UNKNOWN%' THEN 'unverified_reference' WHEN edge_confidence IN ({', '.join(repr(c) for c in V.CORE_CONFIDENCE)}) THEN 'core' WHEN edge_confidence = 'name_only_candidate' THEN 'likely' ELSE 'unverified_reference' END"


@query(f"SELECT {_TIER} AS tier, count(*) AS n FROM ({_CAND}) GROUP BY 1")
def confidence_tier(t, spark):
    return _candidates(t).groupBy(R.tier(F.col("edge_confidence"), F.col("candidate_edge_type")).alias("tier")).agg(F.count("*").alias("n"))


_FAMILY = "CASE candidate_edge_type WHEN 'USES_MATERIAL' THEN 'Physical / Material' WHEN 'HOSTED_BY' THEN 'Model Structure' WHEN 'REFERENCES' THEN 'Referencing' ELSE 'Other' END"


@query(f"SELECT {_FAMILY} AS family, count(*) AS n FROM ({_CAND}) GROUP BY 1")
def relation_family(t, spark):
    return _candidates(t).groupBy(R.family(F.col("candidate_edge_type")).alias("family")).agg(F.count("*").alias("n"))


ROLE_NAMES = ["UIDocument", "ViewSheet", "View3D", "FamilySymbol", "WallFamily", "Parameter", "Definition", "Categories", "MaterialNode", "LevelType", "PhaseFilter", "WorksetTable", "GroupType", "Space", "RentableArea", "IndependentTag", "TextNote", "Line", "GeometryObject", "FailureMessage", "Wall", "Thing"]
ROLE_OF = ["Document", "ViewSheet", "View", "FamilySymbol", "Family", "Parameter", "Parameter", "Category", "Material", "Level", "Phase", "Workset", "Group / Assembly", "Room / Space", "Room / Space", "Annotation / Tag", "Annotation / Tag", "Geometry", "Geometry", "Failures", "Element", "Other"]
_ROLE_SQL = sql_values([(i, n, r) for i, (n, r) in enumerate(zip(ROLE_NAMES, ROLE_OF, strict=True))], "k, name, role")


@query(f"SELECT p_partkey, role FROM part JOIN {_ROLE_SQL} ON k = p_partkey % {len(ROLE_NAMES)}")
def api_role(t, spark):
    name = F.element_at(F.array(*map(F.lit, ROLE_NAMES)), (F.col("p_partkey") % len(ROLE_NAMES) + 1).cast("int"))
    return t("part").select("p_partkey", R.role(name, F.lit(None).cast("string"), F.when(name == "Wall", "element_subtype")).alias("role"))


@query("SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'enum' WHEN 1 THEN 'value_object' ELSE CASE WHEN p_partkey % 5 = 0 THEN 'options_class' WHEN p_partkey % 5 = 1 THEN 'element_subtype' WHEN p_partkey % 5 = 2 THEN CASE WHEN p_size % 4 = 3 THEN 'unknown' ELSE 'utility_class' END ELSE CASE WHEN p_size % 4 = 2 THEN 'utility_class' ELSE 'unknown' END END END AS role FROM part")
def class_role(t, spark):
    kind = F.element_at(F.array(*map(F.lit, ["enum", "struct", "class", "interface"])), (F.col("p_size") % 4 + 1).cast("int"))
    k = F.col("p_partkey") % 5
    name = F.when(k == 0, "ExportOptions").when(k == 2, "WallUtils").otherwise("Thing")
    members = F.array(F.struct(F.lit("method").alias("kind")))
    return t("part").select("p_partkey", R.class_role(kind, name, F.when(k == 1, "true").otherwise("unknown"), members).alias("role"))


@query("WITH known AS (SELECT 'N.' || p_name || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE p_partkey::VARCHAR END AS f, p_name || CASE WHEN p_partkey % 2 = 0 THEN '' ELSE p_partkey::VARCHAR END AS s FROM part), asked AS (SELECT DISTINCT CASE WHEN p_partkey % 3 = 0 THEN 'N.' || p_name WHEN p_partkey % 3 = 1 THEN p_name || p_partkey WHEN p_partkey % 50 = 2 THEN '' ELSE 'X.' || p_name END AS q FROM part), one AS (SELECT s, min(f) AS f FROM known GROUP BY s HAVING count(*) = 1) SELECT q, CASE WHEN q = '' THEN NULL ELSE coalesce(e.f, o.f) END AS resolved, CASE WHEN q = '' THEN 'none' WHEN e.f IS NOT NULL THEN 'exact' WHEN o.f IS NOT NULL THEN 'short_name_fallback' ELSE 'external' END AS how FROM asked LEFT JOIN (SELECT DISTINCT f FROM known) e ON e.f = q LEFT JOIN one o ON o.s = regexp_extract(q, '[^.]*$')")
def resolve_two_pass(t, spark):
    part, k = t("part"), F.col("p_partkey")
    short = F.concat("p_name", F.when(k % 2 == 0, "").otherwise(k.cast("string")))
    known = part.select(F.concat(F.lit("N."), short).alias("full"), short.alias("short"))
    asked = part.select(F.when(k % 3 == 0, F.concat(F.lit("N."), "p_name")).when(k % 3 == 1, F.concat("p_name", k.cast("string"))).when(k % 50 == 2, "").otherwise(F.concat(F.lit("X."), "p_name")).alias("q")).distinct()
    return two_pass(asked, "q", known, "full", "short").select("q", "resolved", F.col("resolved_how").alias("how"))


@query("SELECT DISTINCT 'P' || l_partkey AS id FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)")
def external_stubs(t, spark):
    ends = t("lineitem").select(F.concat(F.lit("P"), "l_partkey").alias("id"))
    return graph.stubs(ends, t("part").where("p_size > 10").select(F.concat(F.lit("P"), "p_partkey").alias("full_type_name")))


def _nodes_and_edges(t):
    """Parts and suppliers as nodes, order lines as typed edges; some parts are missing on purpose."""
    nodes = t("part").where("p_size > 5").select(F.concat(F.lit("P"), "p_partkey").alias("full_type_name"), F.col("p_brand").alias("namespace")).union(t("supplier").select(F.concat(F.lit("S.S"), "s_suppkey"), F.lit("S")))
    nodes = nodes.select("*", R.short_name(F.col("full_type_name")).alias("short_name"), F.lit("class").alias("kind"), F.lit("unknown").alias("class_role"), F.lit("unknown").alias("is_element_candidate"), F.lit(None).cast("string").alias("base_type"), F.lit("").alias("source_url"), F.lit(None).cast("boolean").alias("dll_type_verified"))
    none = lambda c: F.lit(None).cast(c)
    edges = _candidates(t).select("*", F.lit("property").alias("member_kind"), none("array<string>").alias("evidence"), F.lit("").alias("source_url"), none("boolean").alias("dll_signature_verified"), none("string").alias("dll_relationship_scope"), none("boolean").alias("dll_semantic_verified"), none("boolean").alias("lookup_requires_document_context"))
    return nodes, edges


def _graph(t):
    return graph.build(*_nodes_and_edges(t))


_GE = f"SELECT *, {_TIER} AS tier FROM ({_CAND})"


@query(f"SELECT id FROM (SELECT source_type AS id FROM ({_GE}) WHERE tier = 'core' UNION SELECT candidate_target_type FROM ({_GE}) WHERE tier = 'core')")
def core_subgraph(t, spark):
    return graph.core(_graph(t)).nodes.select("id")


@query("SELECT 'exact' AS target_resolution, count(*) AS n FROM lineitem WHERE l_suppkey IN (SELECT s_suppkey FROM supplier) HAVING count(*) > 0 UNION ALL SELECT 'external', count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier) HAVING count(*) > 0")
def target_resolutions(t, spark):
    return _graph(t).resolution_counts().withColumnRenamed("count", "n")


@query("SELECT least('P' || l_partkey, 'S.S' || l_suppkey) AS a, greatest('P' || l_partkey, 'S.S' || l_suppkey) AS b, count(*) AS weight FROM lineitem GROUP BY 1, 2")
def undirected_projection(t, spark):
    g = _graph(t)
    return graph.projection(g.nodes, g.edges, inside=True).select("a", "b", "weight")


@query("SELECT id, count(*) AS degree FROM (SELECT 'P' || l_partkey AS id FROM lineitem UNION ALL SELECT 'S.S' || l_suppkey FROM lineitem) GROUP BY 1")
def node_degree(t, spark):
    g = _graph(t)
    return graph.degrees(graph.projection(g.nodes, g.edges, inside=True))


@query(None)
def communities_local_move(t, spark):
    """Nations as nodes, order lines from a customer's to a supplier's nation as edges; only the 25 nations' projection is moved."""
    nation = lambda name: t("nation").select(F.col("n_nationkey").alias(f"{name}_k"), F.col("n_name").alias(name))
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    edges = lines.join(nation("source"), F.col("c_nationkey") == F.col("source_k")).join(nation("target"), F.col("s_nationkey") == F.col("target_k")).select((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("ord"), "source", "target")
    return community.detect(t("nation").select(F.col("n_name").alias("id")), edges)


_REGIONS = "SELECT n_regionkey AS community_id, n_name AS id, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey) + (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey) AS ends FROM nation"


@query(f"SELECT community_id::BIGINT AS community_id, string_agg(id, ' · ' ORDER BY ends DESC, id) FILTER (n <= 3) AS label, count(*) AS size FROM (SELECT *, row_number() OVER (PARTITION BY community_id ORDER BY ends DESC, id) AS n FROM ({_REGIONS})) GROUP BY 1")
def community_label_top3(t, spark):
    nation = t("nation")
    assigned = nation.select(F.col("n_name").alias("id"), F.col("n_regionkey").cast("long").alias("community_id"))
    nodes = nation.select(F.col("n_name").alias("id"), F.col("n_name").alias("short_name"))
    at = lambda table, key, own: t(table).join(nation.select("n_name", "n_nationkey"), F.col(key) == F.col("n_nationkey")).select(F.col("n_name").alias("source"), F.lit(None).cast("string").alias("target"))
    edges = at("customer", "c_nationkey", "c_custkey").union(at("supplier", "s_nationkey", "s_suppkey"))
    return community.summarise(assigned, nodes, edges).select("community_id", "label", "size")


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'doc_only' ELSE 'confirmed' END AS status FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l USING (doc_id)")
def manifest_confirm(t, spark):
    nodes = t("documents").select("doc_id", F.concat(F.lit("D.N"), "doc_id").alias("full_type_name"))
    return corroborate.type_results(nodes, _types(t)).select("doc_id", "status")


def _types(t):
    full = F.concat(F.lit("D+N"), "doc_id")
    return t("labels").select("doc_id").distinct().select(full.alias("full_type_name"), F.concat(F.lit("N"), "doc_id").alias("short"))


@query("SELECT 'D+N' || doc_id AS full_type_name FROM (SELECT DISTINCT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents WHERE lang = 'en'))")
def manifest_only(t, spark):
    nodes = t("documents").where("lang = 'en'").select("doc_id", F.concat(F.lit("D.N"), "doc_id").alias("full_type_name"))
    return corroborate.undocumented(corroborate.type_results(nodes, _types(t)), _types(t))


@query("WITH m AS (SELECT o_orderkey, l_linenumber - 1 AS place, CASE WHEN l_linenumber % 2 = 0 THEN 'int' ELSE 'System.String' END AS r FROM orders JOIN lineitem ON l_orderkey = o_orderkey), x AS (SELECT o_orderkey, min(place) FILTER (r = 'int') AS hit, min(place) AS any_ FROM m GROUP BY 1) SELECT o.o_orderkey, CASE WHEN x.o_orderkey IS NULL THEN 'member_not_found' WHEN hit IS NOT NULL THEN 'signature_confirmed' ELSE 'signature_mismatch' END AS status, CASE WHEN x.o_orderkey IS NOT NULL THEN 'declared' END AS scope FROM orders o LEFT JOIN x USING (o_orderkey)")
def overload_match(t, spark):
    return corroborate.edge_results(*_overloads(t)).select("o_orderkey", F.col("dll_verified_status").alias("status"), F.col("dll_relationship_scope").alias("scope"))


def _overloads(t):
    """Orders as edges and, with their lines as overloads, as types."""
    order = F.concat(F.lit("N.O"), "o_orderkey")
    lines = t("orders").join(t("lineitem"), F.col("l_orderkey") == F.col("o_orderkey")).select("o_orderkey", F.struct(F.col("l_linenumber").alias("n"), F.when(F.col("l_linenumber") % 2 == 0, "int").otherwise("System.String").alias("r")).alias("x"))
    member = "struct<name:string,kind:string,declaring_type:string,return_type:string,is_static:boolean,parameters:array<struct<name:string,type:string>>>"
    made = F.transform(F.array_sort(F.collect_list("x")), lambda x: F.struct(F.lit("Get").alias("name"), F.lit("method").alias("kind"), F.lit(None).cast("string").alias("declaring_type"), x["r"].alias("return_type"), F.lit(False).alias("is_static"), F.array().cast("array<struct<name:string,type:string>>").alias("parameters")))
    types = lines.groupBy("o_orderkey").agg(made.cast(f"array<{member}>").alias("members")).select(order.alias("full_type_name"), F.concat(F.lit("O"), "o_orderkey").alias("short"), F.array().cast("array<string>").alias("inheritance_chain"), "members")
    edges = t("orders").select(F.col("o_orderkey").alias("ord"), "o_orderkey", order.alias("source_type"), F.lit("Get").alias("member_name"), F.lit("method").alias("member_kind"), F.lit("Int32").alias("return_type"), F.array().cast("array<string>").alias("parameter_types"))
    return edges, types


@query("SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 AND (p_partkey % 2 = 0 OR p_partkey % 5 = 0) THEN TRUE END AS referenced, CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 2 = 0 THEN 'A' WHEN p_partkey % 3 <> 0 AND p_partkey % 5 = 0 THEN 'B' END AS descriptor_class FROM part WHERE p_size <= 25")
def descriptor_corroborate(t, spark):
    """Parts as members of type T: class A resolves the even ones, B every fifth; both add every third themselves."""
    part = t("part").select("p_partkey", "p_size", F.concat(F.lit("M"), "p_partkey").alias("m"))
    # a reference of many rows: the map in one, and what the classes say of each member in one of its own
    one_member = F.array(F.struct(F.col("m").alias("member_name"), F.lit("nameof").alias("name_source"), F.lit(False).alias("requires_document_context"), F.lit(False).alias("has_multiple_variants")))
    resolved = lambda cond: F.when(cond, one_member).otherwise(F.slice(one_member, 1, 0))
    k = F.col("p_partkey")
    made = F.when(k % 3 == 0, F.array("m")).otherwise(F.array().cast("array<string>"))
    one = lambda name, cond: F.struct(F.lit(name).alias("descriptor_class"), resolved(cond).alias("resolved_members"), made.alias("synthetic_extensions"), F.array().cast("array<string>").alias("parser_notes"))
    said = part.select(F.array(one("A", k % 2 == 0), one("B", k % 5 == 0)).alias("descriptors"))
    classes = spark.range(1).select(F.array(*[F.struct(F.lit("T").alias("target_type_short_name"), F.lit(c).alias("descriptor_class"), F.lit("S").alias("section")) for c in "AB"]).alias("descriptor_map"))
    reference = said.unionByName(classes, allowMissingColumns=True)
    edges = part.select(k.alias("ord"), "p_partkey", F.when(F.col("p_size") <= 25, "N.T").otherwise("N.U").alias("source_type"), F.col("m").alias("member_name"), F.lit(None).cast("boolean").alias("lookup_referenced"), F.lit(None).cast("boolean").alias("lookup_requires_document_context"))
    return corroborate.descriptor_results(edges, reference).select("p_partkey", F.col("lookup_referenced").alias("referenced"), "descriptor_class")


@query("SELECT o_orderkey, l.n IS NOT NULL AS member_found, l.n IS NOT NULL AND r.k IS NOT NULL AS edge_found FROM orders LEFT JOIN (SELECT l_orderkey AS k, count(*) AS n FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) l ON l.k = o_orderkey LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_returnflag = 'R') r ON r.k = o_orderkey")
def known_edge_report(t, spark):
    name = lambda c: F.concat(F.lit("N.O"), c)
    checks = t("orders").select(F.col("o_orderkey").alias("check_ord"), name("o_orderkey").alias("source_type"), F.lit("Get").alias("member_name"))
    members = t("lineitem").where("l_linestatus = 'O'").select(name("l_orderkey").alias("full_type_name"), F.lit("Get").alias("member_name"), F.col("l_linenumber").cast("long").alias("ord"))
    edges = t("lineitem").where("l_returnflag = 'R'").select(name("l_orderkey").alias("source_type"), F.lit("Get").alias("member_name"), F.lit("X").alias("candidate_edge_type"), F.lit("Y").alias("candidate_target_type"), F.col("l_linenumber").cast("long").alias("ord"))
    chains = spark.createDataFrame([], "full_type_name string, chain array<string>")
    return corroborate.known_edges(checks, members, chains, edges).select(F.col("check_ord").alias("o_orderkey"), "member_found", "edge_found")


@query("SELECT o_orderkey, o_orderstatus = 'F' AS found, l.k IS NOT NULL AS parsed, coalesce(p, 0) AS properties, coalesce(m, 0) AS methods FROM orders LEFT JOIN (SELECT l_orderkey AS k, count(*) FILTER (l_returnflag = 'R') AS m, count(*) FILTER (l_returnflag <> 'R') AS p FROM lineitem GROUP BY 1) l ON l.k = o_orderkey")
def target_report(t, spark):
    name = lambda c: F.concat(F.lit("N.O"), c)
    wanted = t("orders").select(name("o_orderkey").alias("full_type_name"))
    members = F.collect_list(F.struct(F.when(F.col("l_returnflag") == "R", "method").otherwise("property").alias("kind"), name("l_orderkey").alias("declaring_type")))
    pages = t("lineitem").groupBy("l_orderkey").agg(members.alias("members")).select(name("l_orderkey").alias("full_type_name"), F.lit("class").alias("kind"), "members")
    found = t("orders").where("o_orderstatus = 'F'").select(name("o_orderkey").alias("full_type_name"))
    return corroborate.targets(wanted, found, pages).select(F.substring_index("full_type_name", "O", -1).cast("long").alias("o_orderkey"), "found", "parsed", "properties", "methods")


_ROWS = "SELECT r_name AS source_role, o_orderpriority AS edge_type, o_orderstatus AS target_role, o_orderkey AS ord FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey"


def _rows(t):
    c = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("c_custkey", "r_name")
    return t("orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select(F.col("r_name").alias("source_role"), F.col("o_orderpriority").alias("edge_type"), F.col("o_orderstatus").alias("target_role"), F.col("o_orderkey").alias("ord"))


@query(f"SELECT source_role, edge_type, target_role, count(*) AS weight FROM ({_ROWS}) GROUP BY 1, 2, 3")
def role_triples(t, spark):
    return roles.triples(_rows(t))


@query(f"SELECT source_role, edge_type, target_role, count(*) AS weight FROM ({_ROWS}) GROUP BY 1, 2, 3 HAVING count(*) >= 20")
def min_weight_triples(t, spark):
    return roles.triples(_rows(t), 20)


@query(f"SELECT source_role, edge_type, target_role, count(*) AS weight FROM ({_ROWS}) GROUP BY GROUPING SETS ((source_role, edge_type, target_role), (source_role, edge_type), (source_role), (target_role), (edge_type))")
def grouping_sets(t, spark):
    return roles.sums(_rows(t)).drop("level")


@query("SELECT event_type AS edge_type, count(*) AS n, min(event_id) AS \"first\" FROM events GROUP BY 1 ORDER BY n DESC, 3 LIMIT 3")
def top_relationships_disclosed(t, spark):
    return roles.top_relations(t("events"), 3, "event_type", "event_id").withColumnRenamed("event_type", "edge_type")


@query("SELECT event_type, event_id, n AS place FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events) WHERE n <= 80")
def drilldown_capped(t, spark):
    return roles.examples(t("events"), ["event_type"], 80, "event_id").select("event_type", "event_id", F.col("place").cast("long").alias("place"))


_KEY = "CASE WHEN candidate_edge_type = 'UNKNOWN_ELEMENTID_REFERENCE' THEN regexp_replace(regexp_replace(member_name, '^(GetAll|Get|Set)', ''), 'Ids?$', '') ELSE regexp_extract(candidate_target_type, '[^.]*$') END"
_AXES = f"SELECT *, candidate_edge_type AS axis, {_KEY} AS key FROM ({_CAND}) WHERE candidate_edge_type LIKE 'UNKNOWN%' UNION ALL SELECT *, 'needs_runtime_validation', regexp_extract(candidate_target_type, '[^.]*$') FROM ({_CAND}) WHERE edge_confidence = 'needs_runtime_validation'"


@query(f"SELECT axis, key, count(*) AS count, count(DISTINCT source_type) AS source_types, count(DISTINCT member_name) AS member_names, count(*) FILTER (referenced) AS lookup_referenced_count, count(*) FILTER (verified = 'member_not_found') AS member_not_found_count, min(ord) AS \"first\" FROM ({_AXES}) GROUP BY 1, 2")
def pareto_clusters(t, spark):
    return pareto.clusters(_candidates(t)).drop("examples")


@query(f"SELECT count(*) AS total, count(*) FILTER (candidate_edge_type LIKE 'UNKNOWN%') AS unknown, count(*) FILTER (edge_confidence = 'needs_runtime_validation') AS needs_validation FROM ({_CAND})")
def pareto_share(t, spark):
    return pareto.totals(_candidates(t)).drop("unknown_share")


_RANK = f"list_position([{', '.join(repr(c) for c in V.CONFIDENCE_ORDER)}], edge_confidence)"


@query(f"SELECT ord, edge_confidence FROM ({_CAND}) ORDER BY candidate_edge_type LIKE 'UNKNOWN%', {_RANK}, ord LIMIT 25")
def top_confident(t, spark):
    return pareto.by_confidence(_candidates(t)).select("ord", "edge_confidence")


@query(f"SELECT ord, edge_confidence FROM ({_CAND}) ORDER BY {_RANK} DESC, ord LIMIT 25")
def top_uncertain(t, spark):
    return pareto.by_confidence(_candidates(t), certain=False).select("ord", "edge_confidence")


@query("SELECT p_brand, n, n * 1000 // sum(n) OVER () AS permille, greatest(count(*) OVER () - 15, 0) AS more FROM (SELECT p_brand, count(*) AS n FROM part GROUP BY 1) ORDER BY n DESC, p_brand LIMIT 15")
def unknown_breakdown_pct(t, spark):
    return pareto.breakdown(t("part"), "p_brand").select("p_brand", "n", F.floor(F.col("percent") * 10 + 1e-9).alias("permille"), "more")


_META = f"SELECT {{a}} AS axis, coalesce(CAST({{c}} AS VARCHAR), 'not_checked') AS value, count(*) AS n FROM ({_GE}) GROUP BY 1, 2"


@query(" UNION ALL ".join(_META.format(a=f"'{a}'", c=c) for a, c in (("edge_type", "candidate_edge_type"), ("confidence_tier", "tier"), ("dll_verified_status", "verified"), ("lookup_referenced", "referenced"))) + " UNION ALL SELECT 'edges', 'total', count(*) FROM lineitem UNION ALL SELECT 'nodes', 'total', (SELECT count(*) FROM supplier) + count(DISTINCT p) FROM (SELECT p_partkey AS p FROM part WHERE p_size > 5 UNION ALL SELECT l_partkey FROM lineitem) UNION ALL SELECT 'external_nodes', 'total', count(DISTINCT l_partkey) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 5)")
def graph_metadata(t, spark):
    return graph.metadata(_graph(t))


@query("SELECT p_type AS type_name, count(*) AS n_members FROM part GROUP BY 1")
def enum_catalog(t, spark):
    member = F.struct(F.col("p_type").alias("enum_name"), F.col("p_brand").alias("member_name"), F.lit(None).cast("string").alias("numeric_value"), F.lit("").alias("description"), F.lit("").alias("source_url"))
    pages = t("part").select(F.col("p_partkey").alias("ord"), F.lit("enum").alias("kind"), F.col("p_type").alias("type_name"), F.array(member).alias("enum_members"))
    return files.enum_catalog(pages).select("type_name", F.size("members").cast("long").alias("n_members"))


@query("SELECT event_type AS member_kind, count(*) AS n FROM events GROUP BY 1")
def edges_by_kind_union(t, spark):
    """Written by kind and read back together."""
    path = scratch(spark, "edges-by-kind")
    files.edges_by_kind(t("events").withColumnRenamed("event_type", "member_kind").select("event_id", "member_kind"), path)
    return spark.read.parquet(path).groupBy("member_kind").agg(F.count("*").alias("n"))


@query("SELECT s_suppkey, regexp_replace(regexp_replace(n, '^(GetAll|Get|Set)', ''), 'Ids?$', '') AS key FROM (SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'GetAll' WHEN 1 THEN 'Set' ELSE 'Get' END || s_name || CASE WHEN s_suppkey % 2 = 0 THEN 'Ids' ELSE 'Id' END AS n FROM supplier)")
def member_name_key(t, spark):
    k = F.col("s_suppkey")
    name = F.concat(F.when(k % 3 == 0, "GetAll").when(k % 3 == 1, "Set").otherwise("Get"), "s_name", F.when(k % 2 == 0, "Ids").otherwise("Id"))
    return t("supplier").select("s_suppkey", R.member_key(name).alias("key"))


@query("""WITH e AS (SELECT 'P' || l_partkey AS a, 'S.S' || l_suppkey AS b FROM lineitem), n AS (SELECT a AS id, count(*) AS k FROM e GROUP BY 1 UNION ALL SELECT b, count(*) FROM e GROUP BY 1)
SELECT count(*) AS nodes, count(DISTINCT id) AS ids, sum(k)::BIGINT AS ends, true AS named_by_least, true AS better_than_alone, true AS fewer FROM n""")
def communities_parallel(t, spark):
    """Every node is in one community, named by its smallest member; the partition is better than that of lone nodes."""
    keys = t("lineitem").groupBy("l_partkey", "l_suppkey").agg(F.count("*").alias("weight"))
    pairs = cut(keys.select(F.concat(F.lit("P"), "l_partkey").alias("a"), F.concat(F.lit("S.S"), "l_suppkey").alias("b"), "weight"))
    found = cut(communities.detect(pairs))
    # no id is on both sides
    k = pairs.groupBy(F.col("a").alias("id")).agg(F.sum("weight").alias("k")).union(pairs.groupBy("b").agg(F.sum("weight")))
    groups = found.join(k, "id").groupBy("community").agg(F.count("*").alias("n"), F.min("id").alias("least"), F.sum("k").alias("mass"), F.sum(F.col("k") * F.col("k")).alias("alone"))
    total = groups.agg(F.sum("n").alias("nodes"), F.sum("mass").alias("ends"), F.every(F.col("least") == F.col("community")).alias("named_by_least"), (F.count("*") < F.sum("n")).alias("fewer"), F.sum("alone").alias("alone"), F.sum(F.col("mass") * F.col("mass")).alias("squares"))
    of = found.select("id", "community")
    inside = pairs.join(of.toDF("a", "x"), "a").join(of.toDF("b", "y"), "b").agg(F.sum(F.when(F.col("x") == F.col("y"), 2 * F.col("weight")).otherwise(0)).alias("w"))
    better = (F.col("w").cast("double") * F.col("ends") - F.col("squares")) > -F.col("alone")
    return total.crossJoin(inside).crossJoin(found.agg(F.countDistinct("id").alias("ids"))).select("nodes", "ids", "ends", "named_by_least", better.alias("better_than_alone"), "fewer")  # one row each


_DB = V.DB_NAMESPACE
# Member names and types that the rules are tried on.
MEMBERS = [
    ("Symbol", "property", "FamilySymbol"), ("ViewTemplateId", "property", "ElementId"), ("Id", "property", "ElementId"), ("Number", "property", "string"), ("WorksetId", "property", "WorksetId"), ("GetDependentElements", "method", "IList<ElementId>"),
    ("GetMaterialIds", "method", "ICollection<ElementId>"), ("Children", "method", "IList<ElementId>"), ("CreateLevel", "method", "Level"), ("CreatedPhaseId", "property", "ElementId"), ("Level", "property", "FailureDefinitionId"), ("LevelThing", "property", "Material"),
    ("Widgets", "method", "IList<Widget>"), ("HostedRoom", "property", "bool"), ("Percentage", "property", "double"), ("SetSelf", "method", "Owner"), ("Parent", "property", "Owner"), ("Room", "property", "Room"), ("Plain", "property", "Unheard"), ("Doc", "property", "Document"), ("PlacementLevelId", "property", "LinkElementId"), ("Nothing", "property", None),
]
EXPECTED = [
    ("Symbol", "INSTANCE_OF", "direct_return_type", f"{_DB}.FamilySymbol"), ("ViewTemplateId", "CONTROLLED_BY_TEMPLATE", "elementid_with_strong_name", f"{_DB}.View"), ("Id", "UNKNOWN_ELEMENTID_REFERENCE", "unknown_reference", None),
    ("WorksetId", "OWNED_BY_WORKSET", "direct_return_type", f"{_DB}.Workset"), ("GetDependentElements", "DEPENDS_ON", "elementid_collection_with_strong_name", None), ("GetMaterialIds", "USES_MATERIAL", "elementid_collection_with_strong_name", f"{_DB}.Material"),
    ("Children", "RETURNS_ELEMENT_IDS", "unknown_reference", None), ("CreatedPhaseId", "ASSIGNED_TO_PHASE", "elementid_with_strong_name", f"{_DB}.Phase"), ("LevelThing", "UNKNOWN_DB_OBJECT_REFERENCE", "direct_return_type", f"{_DB}.Material"),
    ("Widgets", "UNKNOWN_DB_OBJECT_REFERENCE", "needs_runtime_validation", f"{_DB}.Widget"), ("HostedRoom", "HOSTED_BY", "name_only_candidate", None), ("Percentage", "TAGS_ELEMENT", "name_only_candidate", None), ("Parent", "UNKNOWN_DB_OBJECT_REFERENCE", "direct_return_type", f"{_DB}.Owner"),
    ("Room", "REFERENCES", "direct_return_type", V.OTHER_NAMESPACE_TARGETS["Room"]), ("Doc", "UNKNOWN_DB_OBJECT_REFERENCE", "direct_return_type", f"{_DB}.Document"), ("PlacementLevelId", "ASSIGNED_TO_LEVEL", "elementid_with_strong_name", f"{_DB}.Level"),
]
_MADE = sql_values([(k, *next(((e, c, x) for name, e, c, x in EXPECTED if name == m[0]), (None, None, None))) for k, m in enumerate(MEMBERS)], "k, edge_type, confidence, target")


@query(f"SELECT p_partkey, edge_type, confidence, target FROM part JOIN {_MADE} ON k = p_partkey % {len(MEMBERS)} WHERE edge_type IS NOT NULL")
def member_edges_of_parts(t, spark):
    """Each part as a member whose name and types are one of MEMBERS."""
    pick = lambda i: F.element_at(F.array(*[F.lit(m[i]) for m in MEMBERS]), (F.col("p_partkey") % len(MEMBERS) + 1).cast("int"))
    blank = F.lit("")
    m = t("part").select(
        F.col("p_partkey").alias("ord"), pick(0).alias("name"), pick(1).alias("kind"), pick(2).alias("return_type"), F.lit(f"{_DB}.Owner").alias("source_type"), blank.alias("raw_signature"),
        F.array().cast("array<struct<name:string,type:string>>").alias("parameters"), blank.alias("summary"), blank.alias("remarks"), blank.alias("source_url"),
    )
    made = classify.member_edges(m, F.col("bare").isin(V.KNOWN_REFERENCES + ["Owner"]))
    return made.select(F.col("ord").alias("p_partkey"), F.col("candidate_edge_type").alias("edge_type"), F.col("edge_confidence").alias("confidence"), F.col("candidate_target_type").alias("target"))


@query(f"SELECT coalesce(verified, 'none') AS value, count(*) AS n, count(*) * 1000 // sum(count(*)) OVER () AS permille FROM ({_CAND}) GROUP BY 1")
def evidence_shares(t, spark):
    """How the candidates stand to the evidence, with their shares."""
    h = corroborate.histogram(_candidates(t), "dll_verified_status")
    return h.select("value", "n", F.floor(F.col("percent") * 10 + 1e-9).alias("permille"))


@query("SELECT p_type AS key, count(*) AS count, min(p_partkey) AS first FROM part GROUP BY 1 HAVING count(*) >= 2 ORDER BY 2 DESC, 3 LIMIT 12")
def clusters_shown(t, spark):
    """The largest groups of at least two, of equal ones that which comes first."""
    rows = t("part").groupBy(F.col("p_type").alias("key")).agg(F.count("*").alias("count"), F.min("p_partkey").alias("first"))
    return pareto.shown(rows, 12, 2)


@query(f"SELECT axis, key, count(*) AS count, count(*) FILTER (referenced) AS lookup_referenced_count, count(*) FILTER (verified = 'member_not_found') AS member_not_found_count, min(ord) AS \"first\", count(DISTINCT source_type) AS exact, true AS near, true AS as_one_pass FROM ({_AXES}) GROUP BY 1, 2")
def cluster_sketches(t, spark):
    """Clusters from the states of four batches, beside exact counts; estimates are near these, and those of one pass."""
    e = _candidates(t)
    states = [pareto.state(e.where(F.col("ord") % 4 == k)) for k in range(4)]
    got = pareto.estimated(states[0].union(states[1]).union(states[2]).union(states[3]))
    once = pareto.estimated(pareto.state(e)).select("axis", "key", F.col("source_types").alias("o"), F.col("member_names").alias("p"))
    exact = pareto.clusters(e).select("axis", "key", F.col("source_types").alias("exact"), F.col("member_names").alias("names"))
    error = 4 * 1.04 / 2 ** (pareto.BITS / 2)
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= 1 + error * F.col(b)
    both = got.join(exact, ["axis", "key"]).join(once, ["axis", "key"])
    return both.select("axis", "key", "count", "lookup_referenced_count", "member_not_found_count", "first", "exact", (near("source_types", "exact") & near("member_names", "names")).alias("near"), ((F.col("source_types") == F.col("o")) & (F.col("member_names") == F.col("p"))).alias("as_one_pass"))
