"""Collects queries and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from catalogue.fixtures import with_fixtures

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under the name of its function."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if oracle:
            ORACLES[function.__name__] = with_fixtures(oracle)
        return function

    return register


def sql_list(values) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


def sql_pairs(mapping: dict[str, str]) -> str:
    return ", ".join(f"('{key}', '{value}')" for key, value in mapping.items())
