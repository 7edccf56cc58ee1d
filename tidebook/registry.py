"""Named queries with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Queries by function name; those whose results SQL can say carry it."""

    def __init__(self) -> None:
        self.known: dict[str, tuple[Query, str | None]] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(f: Query) -> Query:
            self.known[f.__name__] = (f, sql)
            return f

        return keep

    def queries(self) -> dict[str, Query]:
        return {k: f for k, (f, _) in self.known.items()}

    def oracle_sql(self) -> dict[str, str]:
        return {k: sql for k, (_, sql) in self.known.items() if sql}
