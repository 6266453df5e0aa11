"""The registered queries over the driver tables, and the SQL each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from nightglass.session import spread_out

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with its SQL counterpart if SQL can say it."""

    def add(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLE[name] = sql
        return function

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A driver table. All times here are UTC, so the session is set to it."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table for queries that work long on each row: dealt over the cores if it is one small file."""
    return spread_out(table(spark, folder, name))
