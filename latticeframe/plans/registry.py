"""All queries over the driver's tables by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

_queries: dict[str, Callable] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under its own name, with the SQL of the same rows."""

    def keep(f: Callable) -> Callable:
        _queries[f.__name__] = f
        if sql is not None:
            _sql[f.__name__] = sql
        return f

    return keep


def _load() -> None:
    from latticeframe.plans import contract_queries, grid_queries, job_queries, scene_queries, series_queries, stored_queries  # noqa: F401


def queries() -> dict[str, Callable]:
    _load()
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_sql)
