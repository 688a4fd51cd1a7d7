"""Registry of named queries over the driver tables and their SQL oracles.

A query is a callable ``(spark, sf_dir) -> DataFrame``. Its oracle, when the
semantics are deterministic and SQL-expressible, is an ANSI SQL string over the
table views of the same names; output columns carry the same aliases.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return deco
