"""All registered queries and their SQL."""

from __future__ import annotations

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under a name, with the DuckDB SQL of the same result."""

    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _load() -> None:
    from . import q_alloc, q_capacity, q_joins, q_master, q_ml2, q_models, q_planning, q_scalar, q_sequences, q_tables  # noqa: F401


def queries() -> dict:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
