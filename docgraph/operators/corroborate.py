"""Candidates against independent evidence: the compiled manifest, descriptor sources, expected edges and targets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions.typenames import canonical, dotted
from . import ancestry, graph
from .lineage import cut
from .resolve import two_pass


def manifest_types(manifest: DataFrame) -> DataFrame:
    return manifest.select(F.explode("types").alias("t")).select("t.*").withColumn("short", R.short_name(dotted(F.col("full_type_name"))))


def type_results(nodes: DataFrame, types: DataFrame) -> DataFrame:
    """nodes with dll_type_verified, status (confirmed, doc_only), matched_manifest_type and resolution."""
    out = two_pass(nodes.drop("dll_type_verified"), "full_type_name", types, "full_type_name", "short", dotted=True, as_="matched_manifest_type")
    found = F.col("matched_manifest_type").isNotNull()
    how = F.col("matched_manifest_type_how")
    return out.withColumn("dll_type_verified", found).withColumn("status", F.when(found, "confirmed").otherwise("doc_only")).withColumn("resolution", F.when(how == "external", "none").otherwise(how)).drop("matched_manifest_type_how")


def undocumented(results: DataFrame, types: DataFrame) -> DataFrame:
    """Manifest types that no node matched, by name."""
    matched = results.where("matched_manifest_type is not null").select(F.col("matched_manifest_type").alias("full_type_name"))
    return types.select("full_type_name").join(matched, "full_type_name", "left_anti").orderBy("full_type_name")


_TOLD = ["dll_signature_verified", "dll_relationship_scope", "dll_verified_status"]


def signature() -> Column:
    """Return and parameter types of an edge, as they are compared."""
    return F.struct(canonical(F.col("return_type")).alias("returns"), F.transform(F.coalesce("parameter_types", F.array().cast("array<string>")), canonical).alias("takes"))


def question() -> Column:
    """What an edge (with its signature) asks of the manifest, as one text: edges of equal texts get the same answer.

    An edge without a type has a text of its own, so that such edges do not meet in one task.
    """
    asked = F.to_json(F.struct("source_type", "member_name", "member_kind", "signature"))
    return F.when(F.coalesce("source_type", F.lit("")) == "", F.concat(F.lit("-"), F.xxhash64("ord").cast("string"))).otherwise(asked)


def edge_results(edges: DataFrame, types: DataFrame) -> DataFrame:
    """edges (with ord) with the dll_ columns, expected and actual return types, and the declaring type.

    Members are looked up on the type itself, then on its ancestors in order; of all overloads the first that agrees in
    return and parameter types matches. Without one, an own member stands for the mismatch before an inherited one.
    Each question (type, member and signature) is asked once, however many edges have it: edges join with answers, and
    with nothing else.
    """
    q = graph.free_name(edges, "_question")
    e = edges.withColumn("signature", signature()).withColumn(q, question())
    asked = e.where(F.coalesce("source_type", F.lit("")) != "").select(q, "source_type", "member_name", "member_kind", "signature").distinct()
    return with_answers(e.join(answers(asked, types, q), q, "left"), edges.columns)


def with_answers(told: DataFrame, columns: list[str]) -> DataFrame:
    """edge_results() of edges (of these columns) that have m and b of their questions."""
    status = F.when(F.col("b").isNull(), "member_not_found").when(F.col("b.agrees"), "signature_confirmed").otherwise("signature_mismatch")
    note = F.when(F.col("m").isNull(), "source type is not in the manifest").when(F.col("b").isNull(), "member is on neither the type nor an ancestor").when(~F.col("b.agrees"), "no overload has this signature").otherwise("")
    scope = F.when(F.col("b.own"), "declared").when(~F.col("b.own"), "inherited")
    return told.select(
        *[c for c in columns if c not in _TOLD], F.coalesce("b.agrees", F.lit(False)).alias("dll_signature_verified"), scope.alias("dll_relationship_scope"), status.alias("dll_verified_status"), note.alias("note"),
        F.col("return_type").alias("expected_return_type"), F.col("b.actual_return_type").alias("actual_return_type"), F.col("b.actual_declaring_type").alias("actual_declaring_type"),
    )


def answers(asked: DataFrame, types: DataFrame, q: str) -> DataFrame:
    """q, m (the manifest type meant) and b (whether a member agrees, is the type's own, and its types; null if there is none).

    asked: q, source_type, member_name, member_kind and signature, a row for each q. The types and all that they inherit
    from are a forest with intervals; the first owner of a member above a type is the innermost interval of such owners around
    it, so that no question is multiplied by the length of a chain.
    """
    asked = cut(two_pass(asked, "source_type", types, "full_type_name", "short", dotted=True, as_="m").drop("m_how"))
    none = F.array().cast("array<string>")
    # a type is a node by its whole line, so that lines that disagree about a name's ancestors stay apart
    line = types.select("full_type_name", F.concat(F.array("full_type_name"), F.coalesce("inheritance_chain", none)).alias("line"))
    path = lambda i: F.array_join(F.slice("line", i + 1, F.size("line")), "\1")
    nodes = line.select("line", F.posexplode("line").alias("i", "name")).select(path(F.col("i")).alias("id"), F.when(F.col("i") + 1 < F.size("line"), path(F.col("i") + 1)).alias("parent"), "name").distinct()
    place = cut(ancestry.tour(nodes.select("id", "parent")).join(nodes.select("id", "name"), "id"))
    members = types.select(F.col("full_type_name").alias("name"), F.posexplode("members").alias("place", "x")).select(
        "name", "place", F.col("x.name").alias("member_name"), F.col("x.kind").alias("member_kind"), F.struct(F.col("x.return_type").alias("actual_return_type"), F.coalesce("x.declaring_type", "name").alias("actual_declaring_type")).alias("actual"),
        F.struct(canonical(F.col("x.return_type")).alias("returns"), F.coalesce(F.transform("x.parameters", lambda p: canonical(p["type"])), none).alias("takes")).alias("signature"),
    )
    owners = lambda *by: members.groupBy("name", *by).agg(F.min_by("actual", "place").alias("actual")).join(place.select("name", "root", "pre", "post"), "name").drop("name")
    key = ["m", "member_name", "member_kind", "signature"]
    own = line.select(F.col("full_type_name").alias("m"), F.array_join("line", "\1").alias("id")).distinct().join(place.select("id", "root", "pre"), "id").drop("id")
    wanted = asked.where("m is not null").select(*key).distinct().join(own, "m")
    exact = ancestry.nearest(wanted, owners("member_name", "member_kind", "signature"), ["member_name", "member_kind", "signature"], ["actual"])
    either = ancestry.nearest(exact.withColumnRenamed("found", "exact"), owners("member_name", "member_kind"), ["member_name", "member_kind"], ["actual"])
    agrees = F.col("exact").isNotNull()
    which = F.when(agrees, F.col("exact")).otherwise(F.col("found"))
    answer = either.where(which.isNotNull()).select(*key, F.struct(agrees.alias("agrees"), (which["pre"] == F.col("pre")).alias("own"), which["actual"]["actual_return_type"].alias("actual_return_type"), which["actual"]["actual_declaring_type"].alias("actual_declaring_type")).alias("b"))
    answer = answer.groupBy(*key).agg(F.max("b").alias("b"))
    return asked.join(answer, key, "left").select(q, "m", "b")


def descriptor_results(edges: DataFrame, reference: DataFrame) -> DataFrame:
    """Edges of types that descriptors cover, with lookup_referenced (true or null, never false), the descriptor class,
    name source and document context. Of a type's classes, in map order, the first that resolves the member and does
    not add it itself (as a synthetic extension) counts."""
    classes = reference.select(F.posexplode("descriptor_map").alias("place", "d")).select(F.col("d.target_type_short_name").alias("short"), F.col("d.descriptor_class").alias("descriptor_class"), "place")
    files = reference.select(F.explode("descriptors").alias("d")).select("d.*")
    members = files.select("descriptor_class", F.posexplode("resolved_members").alias("at", "x")).select("descriptor_class", "at", F.col("x.member_name").alias("member_name"), F.col("x.name_source").alias("name_source"), F.col("x.requires_document_context").alias("context"))
    made = files.select("descriptor_class", F.explode("synthetic_extensions").alias("member_name")).distinct()
    own = edges.withColumn("short", R.short_name(F.col("source_type")))
    covered = own.join(classes.select("short").distinct(), "short", "left_semi")
    hits = covered.select("ord", "short", "member_name").join(classes, "short").join(made, ["descriptor_class", "member_name"], "left_anti").join(members, ["descriptor_class", "member_name"])
    best = hits.groupBy("ord").agg(F.min_by(F.struct("descriptor_class", "name_source", "context"), F.struct("place", "at")).alias("b"))
    out = covered.drop("lookup_referenced", "lookup_requires_document_context").join(best, "ord", "left")
    return out.select(*[c for c in covered.columns if c not in ("short", "lookup_referenced", "lookup_requires_document_context")], F.when(F.col("b").isNotNull(), True).alias("lookup_referenced"), F.col("b.context").alias("lookup_requires_document_context"), F.col("b.descriptor_class").alias("descriptor_class"), F.col("b.name_source").alias("name_source"))


def annotate_descriptors(edges: DataFrame, reference: DataFrame) -> DataFrame:
    """All edges, the covered ones with what descriptor_results() says."""
    r = descriptor_results(edges, reference).select("ord", F.col("lookup_referenced").alias("_r"), F.col("lookup_requires_document_context").alias("_c"))
    return edges.join(r, "ord", "left").withColumn("lookup_referenced", F.coalesce("_r", "lookup_referenced")).withColumn("lookup_requires_document_context", F.coalesce("_c", "lookup_requires_document_context")).drop("_r", "_c")


def known_edges(checks: DataFrame, members: DataFrame, chains: DataFrame, edges: DataFrame) -> DataFrame:
    """checks (check_ord, source_type, member_name) with where the member was found, and the first edge for it.

    members: full_type_name, member_name, ord; chains: full_type_name, chain. An ancestor counts by its short name.
    """
    exact = checks.join(members.select(F.col("full_type_name").alias("source_type"), "member_name", "ord"), ["source_type", "member_name"]).groupBy("check_ord").agg(F.min("ord").alias("own"))
    up = checks.join(chains.withColumnRenamed("full_type_name", "source_type"), "source_type").select("check_ord", "member_name", F.explode(F.transform("chain", lambda c: F.substring_index(c, ".", -1))).alias("ancestor"))
    near = up.join(members.select("full_type_name", "member_name", "ord", R.short_name(F.col("full_type_name")).alias("ancestor")), ["ancestor", "member_name"]).groupBy("check_ord").agg(F.min_by("full_type_name", "ord").alias("owner"))
    c = checks.join(exact, "check_ord", "left").join(near, "check_ord", "left").withColumn("at", F.when(F.col("own").isNotNull(), F.col("source_type")).otherwise(F.col("owner")))
    e = edges.select(F.col("source_type").alias("at"), "member_name", "candidate_edge_type", "candidate_target_type", "ord")
    best = c.join(e, ["at", "member_name"]).groupBy("check_ord").agg(F.min_by(F.struct("candidate_edge_type", "candidate_target_type"), "ord").alias("e"))
    out = c.join(best, "check_ord", "left")
    note = F.when(F.col("at").isNull(), "member not found").when(F.col("e").isNull(), "member found, no edge").when(F.col("own").isNull(), "found on an ancestor").otherwise("found")
    return out.select("check_ord", "source_type", "member_name", F.col("at").isNotNull().alias("member_found"), F.col("e").isNotNull().alias("edge_found"), "e.candidate_edge_type", "e.candidate_target_type", note.alias("note"))


def targets(wanted: DataFrame, found: DataFrame, pages: DataFrame) -> DataFrame:
    """wanted (full_type_name) with whether it was discovered and parsed, and its members by kind."""
    counts = pages.select(F.explode("members").alias("m")).groupBy(F.col("m.declaring_type").alias("full_type_name")).agg(F.count_if(F.col("m.kind") == "property").alias("properties"), F.count_if(F.col("m.kind") == "method").alias("methods"))
    parsed = pages.where(F.col("kind").isin("class", "struct", "interface", "enum")).select("full_type_name").distinct().withColumn("parsed", F.lit(True))
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return wanted.join(found.select("full_type_name").distinct().withColumn("found", F.lit(True)), "full_type_name", "left").join(parsed, "full_type_name", "left").join(counts, "full_type_name", "left").select("full_type_name", F.coalesce("found", F.lit(False)).alias("found"), F.coalesce("parsed", F.lit(False)).alias("parsed"), zero("properties"), zero("methods"))


def histogram(results: DataFrame, column: str) -> DataFrame:
    """value, n and percent of all rows."""
    counts = results.groupBy(F.coalesce(F.col(column).cast("string"), F.lit("none")).alias("value")).agg(F.count("*").alias("n"))
    return counts.crossJoin(F.broadcast(counts.agg(F.sum("n").alias("_all")))).withColumn("percent", 100 * F.col("n") / F.col("_all")).drop("_all")
