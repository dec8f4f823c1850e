"""Where named queries and the SQL that each is held against are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by name, and for those that SQL can express the equivalent statement."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def add(function: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"{name} is registered twice")
            self.queries[name] = function
            if sql is not None:
                self.sql[name] = sql
            return function

        return add
