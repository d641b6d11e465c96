"""The registry of the library's own queries."""

from __future__ import annotations

from importlib import import_module

from corpusloom.queries.base import ORACLES, QUERIES, Query

MODULES = ("text", "vectors", "graph", "bundle", "blocks", "evaluate", "reading", "xml", "structure", "records", "plans", "stored", "readers")


def _load() -> None:
    for name in MODULES:
        import_module(f"corpusloom.queries.{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(ORACLES)
