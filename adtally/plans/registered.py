"""Queries over the driver tables, each next to the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from adtally.plans.driver_model import Tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register a function of the tables, and the SQL for the same rows if there is one."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        QUERIES[name] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def load_all() -> None:
    """Import the modules that register queries."""
    from adtally.plans import queries_changes, queries_keyed, queries_reporting, queries_reshape, queries_tables  # noqa: F401
