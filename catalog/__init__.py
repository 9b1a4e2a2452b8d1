"""Registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query (spark, sf_dir) -> DataFrame under a name."""

    def keep(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return keep


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table whose texts are to be read."""
    return table(spark, sf_dir, name).select(*columns)


from . import companies, crm, reports, sites, text, writes  # noqa: E402,F401
