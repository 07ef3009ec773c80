"""Named queries and the SQL that says what each must return."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Catalog:
    queries: dict[str, Query] = field(default_factory=dict)
    sql: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            if name in self.queries:
                raise ValueError(f"query {name} exists")
            self.queries[name] = query
            if sql is not None:
                self.sql[name] = sql
            return query

        return register


CATALOG = Catalog()
query = CATALOG.add
