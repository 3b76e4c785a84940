"""Registry of named queries: ``name -> (spark builder, oracle SQL or None)``.

Every builder takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole driver tables.  Oracle SQL is DuckDB's dialect over the raw tables.
Modules register their own entries with ``@query(name, sql)``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Builder] = {}
_ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = fn
        if sql is not None:
            _ORACLE[name] = sql
        return fn
    return deco


def _load_all() -> None:
    # import for side effects: each module registers its queries
    from basketflow.plans import (  # noqa: F401
        q_cf, q_features, q_labels, q_model, q_streaming, q_text, q_io)


def queries() -> dict[str, Builder]:
    _load_all()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load_all()
    return dict(_ORACLE)
