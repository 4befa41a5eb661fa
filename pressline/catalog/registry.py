"""Registered queries: name -> Spark callable, oracle SQL and the survey rows it covers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pressline.bindings import Tables, with_bindings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SURVEY: dict[str, list[str]] = {}


def query(name: str, survey: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under a name."""
    def register(fn: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        SURVEY[name] = survey.split()
        if sql:
            ORACLES[name] = with_bindings(sql)
        return fn
    return register
