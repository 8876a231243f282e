"""The queries of the engine and their SQL."""

from __future__ import annotations

from .plans import pages, registry, relations, streams, typed  # noqa: F401


def queries() -> dict:
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(registry.SQL)
