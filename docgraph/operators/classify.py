"""Pages to node and edge candidates: inheritance chains, class roles, the member decision tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules as R
from ..functions import vocabulary as V
from .lineage import cut

TYPE_KINDS = ["class", "struct", "enum", "interface"]
_ONE_ARGUMENT = rf"^(?:{'|'.join(V.COLLECTIONS)})\s*<\s*([\w.]+)\s*>$"


def chains(pages: DataFrame) -> DataFrame:
    """full_type_name, chain (bases upwards, as spelled) and is_element (true, false, unknown) of class and struct pages.

    A base is looked up by its full name, else by its short name in the last page of that short name. Each round appends
    to every unfinished chain the chain of its last base, so their lengths double; rounds end when all chains have ended,
    at a name without a base or before the first name that would come again. No length is too long. Element itself, and what
    has it above, is one; a chain that ends at Object or ValueType, or comes round, is none; of others it is unknown.
    """
    own = pages.where(F.col("kind").isin(TYPE_KINDS))
    typed = own.where(F.col("kind").isin("class", "struct"))
    last = lambda df, key, value: df.groupBy(key.alias("k")).agg(F.max_by(value, "ord").alias("v"))
    by_full = last(typed, F.col("full_type_name"), F.col("base_type"))
    # a short name leads to a page, and from there to that page's base
    to_full = last(own, R.short_name(F.col("full_type_name")), F.col("full_type_name")).select(F.col("k").alias("s"), F.col("v").alias("f"))
    by_short = to_full.join(by_full, F.col("f") == F.col("k")).select("s", F.col("v").alias("bv"))
    step_full = by_full.select(F.col("k").alias("fk"), F.col("v").alias("fv"))
    names = own.select("full_type_name").distinct()
    at = names.select(F.col("full_type_name").alias("at")).union(by_full.where("v <> ''").select("v")).distinct()
    stepped = at.join(step_full, F.col("at") == F.col("fk"), "left").withColumn("sn", R.short_name(F.col("at"))).join(by_short, F.col("sn") == F.col("s"), "left").withColumn("next", F.nullif(F.coalesce("fv", "bv"), F.lit("")))
    none = F.array().cast("array<string>")
    stepped = stepped.withColumn("end", F.when(F.col("next") == F.col("at"), "loop").when(F.col("next").isNull(), "open"))
    now = stepped.select("at", F.when(F.col("end").isNull(), F.array("next")).otherwise(none).alias("chain"), F.when(F.col("end").isNull(), F.col("next")).alias("last"), "end")
    now = cut(now)
    while not now.where("last is not null").isEmpty():
        far = now.select(F.col("at").alias("fat"), F.col("chain").alias("more"), F.col("last").alias("further"), F.col("end").alias("far_end"))
        grown = now.join(far, F.col("last") == F.col("fat"), "left").withColumn("all", F.concat("chain", F.coalesce("more", none)))
        # each name has one base: behind the first name that comes again nothing is new
        grown = grown.withColumn("whole", F.array_distinct(F.concat(F.array("at"), "all"))).withColumn("again", F.size("whole") <= F.size("all"))
        now = cut(grown.select("at", F.slice("whole", F.lit(2), F.greatest(F.size("whole") - 1, F.lit(0))).alias("chain"), F.when(~F.col("again"), F.col("further")).alias("last"), F.when(F.col("again"), "loop").otherwise(F.coalesce("end", "far_end")).alias("end")))
    done = names.join(now, F.col("full_type_name").eqNullSafe(F.col("at"))).select("full_type_name", "chain")
    # a chain that came round again ends at a type whose base is known, if it is spelled in full
    based = by_full.where("v <> ''").select(F.col("k").alias("end"), F.lit(True).alias("based"))
    done = done.withColumn("end", F.try_element_at("chain", F.lit(-1))).join(based, "end", "left")
    is_one = F.exists(F.concat("chain", F.array("full_type_name")), lambda c: F.substring_index(c, ".", -1) == "Element")
    element = F.when(is_one, "true").when(F.size("chain") == 0, "unknown").when(F.substring_index("end", ".", -1).isin("Object", "ValueType") | F.col("based"), "false").otherwise("unknown")
    return done.select("full_type_name", "chain", element.alias("is_element"))


def nodes(pages: DataFrame) -> DataFrame:
    """Node candidates of the type pages (with ord), in their order."""
    p = pages.where(F.col("kind").isin(TYPE_KINDS)).join(chains(pages), "full_type_name", "left")
    element = F.when(F.col("kind") == "enum", "false").otherwise(F.coalesce("is_element", F.lit("unknown")))
    chain = F.coalesce("chain", F.array().cast("array<string>"))
    evidence = F.array_compact(
        F.array(
            F.concat(F.lit("declared kind: "), "kind"),
            F.when(F.coalesce("base_type", F.lit("")) != "", F.concat(F.lit("syntax block base list: "), "base_type")),
            F.when(F.size(chain) > 0, F.concat(F.lit("resolved inheritance chain: "), F.array_join(chain, " -> "))),
            F.when(F.col("kind") == "enum", "enums are never element candidates"),
        )
    )
    p = p.withColumn("is_element_candidate", element).withColumn("inheritance_chain", chain)
    return p.select(
        "ord", "full_type_name", F.col("type_name").alias("short_name"), "kind", "namespace", "base_type", "inheritance_chain", "is_element_candidate",
        R.class_role(F.col("kind"), F.col("type_name"), F.col("is_element_candidate"), F.col("members")).alias("class_role"), evidence.alias("evidence"), "source_url", F.lit(None).cast("boolean").alias("dll_type_verified"),
    )


def member_edges(members: DataFrame, known: Column) -> DataFrame:
    """The decision tree for members, pure column expressions; rows without a signal go.

    members: name, kind, source_type, return_type, parameters, raw_signature, summary, remarks, source_url and ord;
    known: whether the bare return type is a known reference.
    """
    m = members.where(F.coalesce("return_type", F.lit("")) != "").withColumn("ret", F.trim("return_type"))
    m = m.withColumn("bare", R.short_name(F.col("ret"))).withColumn("arg", F.nullif(F.regexp_extract("ret", "(?U)" + _ONE_ARGUMENT, 1), F.lit("")))
    m = m.withColumn("inner", R.short_name(F.col("arg"))).withColumn("kw", R.keyword(F.col("name"))).withColumn("known", F.coalesce(known, F.lit(False)))
    inner, own = F.coalesce("inner", F.lit("")), R.short_name(F.col("source_type"))
    m = m.where(~F.col("bare").isin(V.VALUE_TYPES) & ~inner.isin(V.VALUE_TYPES))
    factory = F.col("name").startswith("Create") & ~F.col("name").startswith("Created")
    m = m.where(~((F.col("kind") == "method") & (factory | (F.col("bare") == own) | (inner == own))))
    typed = F.col("bare").isin(list(V.TYPED_IDS))
    is_id, ids = F.col("ret").isin(V.ID_TYPES), inner.isin(V.ID_TYPES) & F.col("arg").isin(V.ID_TYPES)
    hint = F.col("kw.target_hint")
    direct = ~is_id & ~ids & ~typed & ~F.col("bare").isin(V.SCALARS + V.VALUE_TYPES) & (F.col("known") | F.coalesce(hint == F.col("bare"), F.lit(False)))
    other = F.col("arg").isNotNull() & ~ids & ~inner.isin(V.SCALARS + V.VALUE_TYPES)
    m = m.withColumn("branch", R.first_match([(typed, F.lit("typed")), (direct, F.lit("direct")), (is_id, F.lit("id")), (ids, F.lit("ids")), (other, F.lit("other")), (F.col("kw").isNotNull(), F.lit("name"))])).where("branch is not null")
    conflict = F.coalesce(hint != F.col("bare"), F.lit(False))
    b, edge, has = F.col("branch"), F.col("kw.edge_type"), F.col("kw").isNotNull()
    typed_of = lambda i: R.first_match([(F.col("bare") == k, F.lit(v[i])) for k, v in V.TYPED_IDS.items()])
    object_ = F.lit("UNKNOWN_DB_OBJECT_REFERENCE")
    m = m.withColumn(
        "candidate_edge_type",
        R.first_match([(b == "typed", typed_of(1)), ((b == "direct") & conflict, object_), (b.isin("direct", "other"), F.coalesce(edge, object_)), (b == "id", F.coalesce(edge, F.lit("UNKNOWN_ELEMENTID_REFERENCE"))), (b == "ids", F.coalesce(edge, F.lit("RETURNS_ELEMENT_IDS")))], edge),
    )
    m = m.withColumn("target", R.first_match([(b == "typed", typed_of(0)), (b == "direct", F.col("bare")), (b == "other", F.col("arg"))], hint))
    said = R.phrase(F.coalesce("summary", F.lit("")), F.coalesce("remarks", F.lit("")))
    m = m.withColumn("said", said)
    confidence = R.first_match(
        [(b.isin("typed", "direct"), F.lit("direct_return_type")), ((b == "id") & has, F.lit("elementid_with_strong_name")), ((b == "ids") & has, F.lit("elementid_collection_with_strong_name")), (b.isin("id", "ids"), F.lit("unknown_reference")), (b == "other", F.lit("needs_runtime_validation"))],
        F.lit("name_only_candidate"),
    )
    m = m.withColumn("base_confidence", confidence)
    upgraded = F.when(F.col("said").isNotNull() & F.col("base_confidence").isin("name_only_candidate", "unknown_reference"), "docs_semantic_hint").otherwise(F.col("base_confidence"))
    named = R.first_match([(F.col("target") == k, F.lit(v)) for k, v in V.OTHER_NAMESPACE_TARGETS.items()], F.concat(F.lit(V.DB_NAMESPACE + "."), "target"))
    full = F.when((F.coalesce("target", F.lit("")) != "") & ~F.col("target").startswith(V.ROOT_NAMESPACE), named).otherwise(F.col("target"))
    by_name = F.concat(F.lit("member name '"), "name", F.lit("' matches: "), F.col("kw.pattern"))
    returns = lambda text: F.concat(F.lit("return type '"), "ret", F.lit("' " + text))
    evidence = F.array_compact(
        F.array(
            F.when((b == "direct") & conflict, F.concat(by_name, F.lit(", which implies '"), hint, F.lit("', but the return type is another"))),
            F.when(b.isin("id", "ids", "name") & has, by_name),
            R.first_match([(b == "typed", returns("is an id that names its target")), (b == "direct", returns("is a known object type")), (b == "other", returns("is a collection whose elements are not known statically")), (b.isin("id", "ids") & ~has, returns("wraps ids and the name gives no hint"))]),
            F.when(F.col("said").isNotNull(), F.concat(F.lit("documentation says: "), "said")),
        )
    )
    notes = F.array_compact(F.array(F.when((b == "id") & has & hint.isNull(), "no target is mapped to this name"), F.when(b == "other", "confirm the element type in a live model")))
    none = lambda t: F.lit(None).cast(t)
    return m.select(
        "ord", "source_type", F.col("name").alias("member_name"), F.col("kind").alias("member_kind"), "raw_signature", F.col("ret").alias("return_type"), F.transform("parameters", lambda p: p["type"]).alias("parameter_types"),
        full.alias("candidate_target_type"), "candidate_edge_type", upgraded.alias("edge_confidence"), evidence.alias("evidence"), "source_url", notes.alias("parser_notes"),
        none("boolean").alias("dll_signature_verified"), none("string").alias("dll_relationship_scope"), none("boolean").alias("dll_semantic_verified"), none("string").alias("dll_verified_status"),
        none("boolean").alias("lookup_referenced"), none("boolean").alias("lookup_requires_document_context"),
    )


def edges(pages: DataFrame) -> DataFrame:
    """Edge candidates of all members of all pages, numbered in page and member order."""
    members = pages.select(F.col("ord").alias("page_ord"), "full_type_name", F.posexplode("members").alias("member_ord", "m")).select(
        F.struct("page_ord", "member_ord").alias("ord"), F.coalesce(F.nullif("m.declaring_type", F.lit("")), "full_type_name").alias("source_type"), "m.*"
    )
    types = pages.where(F.col("kind").isin("class", "struct", "interface")).select(F.col("type_name").alias("known_name")).distinct()
    joined = members.withColumn("b", R.short_name(F.trim("return_type"))).join(types, F.col("b") == F.col("known_name"), "left")
    return member_edges(joined, F.col("known_name").isNotNull() | F.col("b").isin(V.KNOWN_REFERENCES))
