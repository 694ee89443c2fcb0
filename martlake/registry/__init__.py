"""Registry of named queries (Spark builder + equivalent DuckDB SQL).

Each module under this package registers its keys on import. A query is a
callable ``(spark, sf_dir) -> DataFrame`` over the driver's tables; the SQL
text, when given, is the independent oracle over the same tables.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

_MODULES = ("marts", "quality", "monitors", "functions", "loads", "sources", "streams", "jobs")


def register(key: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE_SQL[key] = sql
        return fn
    return deco


def load_all() -> None:
    for m in _MODULES:
        importlib.import_module(f"martlake.registry.{m}")


def queries() -> dict[str, QueryFn]:
    load_all()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    load_all()
    return dict(ORACLE_SQL)
