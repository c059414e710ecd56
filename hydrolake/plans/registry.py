"""Registered queries: an operator's query and its SQL twin side by side."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Decorator: register a query under ``name`` with the SQL that gives equal rows."""

    def add(f: Query) -> Query:
        if name in _QUERIES:
            raise ValueError(f"query {name} is registered twice")
        _QUERIES[name] = f
        if sql is not None:
            _SQL[name] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_SQL)


def _load() -> None:
    import importlib

    for module in MODULES:
        importlib.import_module(f"hydrolake.plans.{module}")


MODULES: tuple[str, ...] = ("telemetry", "climate", "demand", "forecast", "pixels", "streams")
