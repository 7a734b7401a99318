"""A registry of named queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def add(function: Query) -> Query:
            known = name or function.__name__
            self.queries[known] = function
            if sql:
                self.oracles[known] = sql
            return function

        return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
