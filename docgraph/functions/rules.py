"""Ordered rule lists as Column expressions: the first rule that holds decides. Everything compiles to CASE WHEN."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def test(kind: str, words: list[str], text: Column) -> Column:
    """One test of a text against words: contains, prefix, suffix or exact."""
    if kind == "exact":
        return text.isin(words)
    how = {"contains": text.contains, "prefix": text.startswith, "suffix": text.endswith}[kind]
    return any_of([how(w) for w in words])


def first_match(rules: list[tuple[Column, Column]], otherwise: Column | None = None) -> Column:
    """The value of the first (test, value) whose test is true; null tests do not hold."""
    out = F
    for holds, value in rules:
        out = out.when(holds, value)
    return out.otherwise(otherwise) if otherwise is not None else out


def keyword(name: Column, rules=None) -> Column:
    """struct(edge_type, target_hint, pattern) of the first member-name rule, case-insensitive; null without one."""
    low = F.lower(name)
    text = lambda x: F.lit(x).cast("string")
    return first_match([
        (test(kind, [w.lower() for w in words], low), F.struct(text(edge).alias("edge_type"), text(hint).alias("target_hint"), text(f"{kind} {'|'.join(words)}").alias("pattern")))
        for kind, words, edge, hint in (rules or V.KEYWORDS)
    ])


def phrase(*texts: Column) -> Column:
    """The first phrase, in list order, of the first text that has one."""
    return F.coalesce(*[first_match([(F.lower(t).contains(p), F.lit(p)) for p in V.DOC_PHRASES]) for t in texts])


def tier(confidence: Column, edge_type: Column) -> Column:
    return first_match(
        [(confidence == "needs_runtime_validation", F.lit("needs_validation")), (edge_type.isin(V.UNKNOWN_EDGES), F.lit("unverified_reference")), (confidence.isin(V.CORE_CONFIDENCE), F.lit("core")), (confidence == "name_only_candidate", F.lit("likely"))],
        F.lit("unverified_reference"),
    )


def rank(confidence: Column) -> Column:
    """Place of a confidence label in display order, from 0."""
    return F.array_position(F.array(*map(F.lit, V.CONFIDENCE_ORDER)), confidence) - 1


def role(name: Column, base: Column, class_role: Column) -> Column:
    """Semantic role of a type."""
    base, class_role = F.coalesce(base, F.lit("")), F.coalesce(class_role, F.lit(""))

    def one(kind: str, words: list[str]) -> Column:
        if kind == "base_prefix":
            return test("prefix", words, base)
        if kind == "suffix_and_base_contains":
            return name.endswith(words[0]) & base.contains(words[1])
        return test("exact", words, class_role) if kind == "class_role" else test(kind, words, name)

    return first_match([(any_of([one(k, w) for k, w in tests]), F.lit(r)) for r, tests in V.ROLE_RULES], F.lit("Other"))


def family(edge_type: Column) -> Column:
    return F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in V.FAMILIES.items() for x in kv]), edge_type), F.lit("Other"))


def class_role(kind: Column, name: Column, is_element: Column, members: Column) -> Column:
    """Structural role of a type page; members: array of structs with a field kind."""
    return first_match(
        [
            (kind == "enum", F.lit("enum")),
            (kind == "struct", F.lit("value_object")),
            (name.endswith("Options"), F.lit("options_class")),
            (name.isin("Element", "ElementType"), F.lit("element_type")),
            (is_element == "true", F.lit("element_subtype")),
            ((kind != "interface") & (test("suffix", ["Utils", "Utility", "Utilities"], name) | ((F.size(members) > 0) & F.forall(members, lambda m: m["kind"] == "method"))), F.lit("utility_class")),
        ],
        F.lit("unknown"),
    )


def short_name(full: Column) -> Column:
    return F.substring_index(full, ".", -1)


def bare_name(full: Column) -> Column:
    """Short name, '(none)' for null and empty."""
    return F.when(F.coalesce(full, F.lit("")) == "", F.lit("(none)")).otherwise(short_name(full))


def member_key(name: Column) -> Column:
    """Member name without one leading GetAll, Get or Set and one trailing Id or Ids; the name itself if nothing is left."""
    cut = F.regexp_replace(F.regexp_replace(name, "^(?:GetAll|Get|Set)", ""), "Ids?$", "")
    return F.when(cut == "", name).otherwise(cut)


def duration(seconds: Column) -> Column:
    """Seconds as 1h02m, 3m04s or 5s; unknown for null, negative and non-finite values."""
    s = F.round(seconds).cast("long")
    h, m = F.floor(s / 3600), F.floor(s % 3600 / 60)
    bad = seconds.isNull() | F.isnan(seconds) | (seconds < 0) | (seconds == float("inf"))
    return F.when(bad, "unknown").when(h > 0, F.format_string("%dh%02dm", h, m)).when(m > 0, F.format_string("%dm%02ds", m, s % 60)).otherwise(F.format_string("%ds", s))


def eta(uncached: Column, average: Column, cached: Column, average_hit: Column) -> Column:
    return uncached * average + cached * average_hit


def share(part: Column, total: Column) -> Column:
    return F.when(total == 0, F.lit(0.0)).otherwise(part / total)


def root_scale(weight: Column, largest: Column, low: float, high: float) -> Column:
    """A visual size between low and high by the square root of a weight's share."""
    return F.lit(low) + F.sqrt(share(weight, largest)) * (high - low)


def html_safe_json(text: Column) -> Column:
    return F.replace(text, F.lit("</"), F.lit("<\\/"))
