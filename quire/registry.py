"""Every query of the engine with its SQL, by name.

A name begins with the identifier of its operator.  ``plans`` holds the queries;
importing a module of it fills the registry.
"""

from __future__ import annotations

import importlib
import pkgutil
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the DuckDB SQL that gives its rows, if there is one."""

    def put(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"two queries named {name}")
        _QUERIES[name] = f
        if sql:
            _SQL[name] = sql
        return f

    return put


def _load() -> None:
    from . import plans

    for module in pkgutil.iter_modules(plans.__path__):
        importlib.import_module(f"{plans.__name__}.{module.name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
