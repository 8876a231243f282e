"""Type names in one spelling, so that documentation and compiled metadata can be compared. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import vocabulary as V


def dotted(name: Column) -> Column:
    """Nested types with a dot for the runtime's plus."""
    return F.replace(name, F.lit("+"), F.lit("."))


def canonical(name: Column) -> Column:
    """Canonical spelling; '' for null, empty and void."""
    s = F.trim(F.coalesce(name, F.lit("")))
    steps = [
        (r"`\d+", ""),  # number of generic arguments
        (r"\[\[\s*([^,\[\]]+),[^\[\]]*\]\]", "[$1]"),  # argument with its assembly
        (r"\[", "<"),
        (r"\]", ">"),
        (r"^([^()<>]+)\((.*)\)$", "$1<$2>"),  # generic arguments in parentheses
        (r"\s*([<>])\s*", "$1"),
        (r"\+", "."),
        (r"(?U)(?:\w+\.)+(\w+)", "$1"),  # namespaces
        *[(rf"\b{a}\b", b) for a, b in V.RUNTIME_NAMES.items()],
        (r"\s*,\s*", ","),
    ]
    for pattern, to in steps:
        s = F.regexp_replace(s, pattern, to)
    return F.regexp_replace(s, "(?i)^void$", "")
