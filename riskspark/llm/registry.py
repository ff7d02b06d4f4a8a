"""Queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

import importlib
import pkgutil

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return add


def load() -> tuple[dict, dict[str, str]]:
    """All queries and their SQL."""
    here = importlib.import_module("riskspark.llm")
    for m in sorted(m.name for m in pkgutil.iter_modules(here.__path__) if m.name.startswith("queries_")):
        importlib.import_module(f"riskspark.llm.{m}")
    return dict(QUERIES), dict(ORACLES)
