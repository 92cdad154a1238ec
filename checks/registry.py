"""Where queries and their SQL twins are registered."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .relations import Relations, duck_query

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(name: str, sql: str | None = None, needs: tuple[str, ...] = ()):
    """Register a query over relations under ``name``, with its SQL over the relations ``needs``."""

    def add(build: Callable[[Relations], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = lambda spark, sf_dir: build(Relations(spark, sf_dir, needs))
        if sql is not None:
            ORACLES[name] = duck_query(sql, *needs)
        return build

    return add
