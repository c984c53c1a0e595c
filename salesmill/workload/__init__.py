"""Registered queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Workload:
    """Queries by name, each with its SQL where SQL can express it."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(fn: Query) -> Query:
            self.queries[name] = fn
            if sql is not None:
                self.sql[name] = sql
            return fn

        return keep


def everything() -> tuple[dict[str, Query], dict[str, str]]:
    from . import access, files, jobs, loading, quality, sales, shaping

    queries: dict[str, Query] = {}
    sql: dict[str, str] = {}
    for module in (sales, access, shaping, quality, loading, files, jobs):
        queries |= module.WORK.queries
        sql |= module.WORK.sql
    return queries, sql
