"""Name -> query and name -> SQL of the core; the entry file adds the training-data ones if they are present."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under `name`, with the SQL that gives the same rows if there is one."""

    def add(f: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add
