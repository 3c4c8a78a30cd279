"""All registered queries of the engine's own operators, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function of (spark, sf_dir) under its name; sql: DuckDB SQL for the same rows."""

    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLE_SQL[fn.__name__] = sql
        return fn

    return add


from . import q_live, q_more, q_records, q_reports, q_signals, q_tables, q_text  # noqa: E402,F401  the modules register their queries
