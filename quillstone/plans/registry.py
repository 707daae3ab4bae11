"""The registered queries and their SQL twins, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query under a name, with SQL that gives the same rows."""

    def keep(query: Query) -> Query:
        _QUERIES[name] = query
        if sql:
            _SQL[name] = sql
        return query

    return keep


def _load() -> None:
    from . import catalog, dialogue, extraction, fields, forms, identity, maintenance, metrics, retrieval, routing, scans, streams, texts  # noqa: F401


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)
