"""Registry of queries and their SQL answers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ANSWERS: dict[str, str] = {}


def query(name: str, answer: str | None = None) -> Callable[[Query], Query]:
    """Register a query and the DuckDB SQL that gives the same rows."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if answer is not None:
            ANSWERS[name] = answer
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once_per_session(build: Callable) -> Callable:
    """Remember ``build(spark, sf_dir)`` for the life of the Spark application, and for each of further arguments.

    For source files and ingest tables that several queries read.
    """
    built: dict[tuple[str, ...], object] = {}

    def remembered(spark: SparkSession, sf_dir: str, *which: str):
        key = (spark.sparkContext.applicationId, sf_dir, *which)
        if key not in built:
            built[key] = build(spark, sf_dir, *which)
        return built[key]

    return remembered
