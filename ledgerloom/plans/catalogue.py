"""The query catalogue: every registered query with its SQL.

A query is a function of (spark, sf_dir). ``needs`` names the fixtures that its
SQL reads; their definitions are put before it.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .fixtures import FIXTURES

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
_MODULES = ("scalars", "links", "people", "registry", "contacts", "metrics", "files", "streams")


def query(sql: str | None = None, needs: str = "", ctes: str = "") -> Callable:
    """Registers a function as a query of its own name."""

    def register(f):
        _QUERIES[f.__name__] = f
        if sql:
            parts = [f"{n} AS ({FIXTURES[n].sql})" for n in needs.split()] + ([ctes.strip()] if ctes else [])
            _SQL[f.__name__] = (f"WITH {',\n'.join(parts)}\n" if parts else "") + sql.strip()
        return f

    return register


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"{__package__}.{m}")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
