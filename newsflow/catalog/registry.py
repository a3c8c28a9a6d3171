"""Named queries over the given tables, each with SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from newsflow.session import prepare

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its counterpart, where SQL can express it."""

    def register(build: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            return build(prepare(spark), folder)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
