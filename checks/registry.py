"""Registered queries and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def check(name: str, sql: str) -> Callable[[Query], Query]:
    def register(query: Query) -> Query:
        QUERIES[name] = query
        ORACLES[name] = sql
        return query

    return register
