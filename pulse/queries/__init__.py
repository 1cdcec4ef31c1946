"""Queries over the given tables, one per operator, with the SQL they must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None):
        def register(query: Query) -> Query:
            key = name or query.__name__
            if key in self.queries:
                raise ValueError(f"query {key} is registered twice")
            self.queries[key] = query
            if sql is not None:
                self.sql[key] = sql
            return query

        return register


registry = Registry()


def load() -> Registry:
    from pulse.queries import (  # noqa: F401
        collection,
        display,
        ingestion,
        rankings,
        reception,
        resolution,
        seasons,
        series,
        streams,
    )

    return registry
