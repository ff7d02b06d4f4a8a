"""All registered queries by name."""

from __future__ import annotations

import importlib
import pkgutil

from riskspark import queries as _families
from riskspark.queries import registry


def _load() -> None:
    for m in sorted(m.name for m in pkgutil.iter_modules(_families.__path__)):
        importlib.import_module(f"{_families.__name__}.{m}")


def queries() -> dict:
    _load()
    return dict(registry.QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(registry.ORACLES)
