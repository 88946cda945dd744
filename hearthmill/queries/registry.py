"""Name, query and SQL of every registered query."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def register(function):
        @wraps(function)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return function(spark, sf_dir)

        QUERIES[function.__name__] = in_utc
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; its zoneless timestamps are UTC."""
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    zoneless = [column for column, kind in rows.dtypes if kind == "timestamp_ntz"]
    return rows.withColumns({column: rows[column].cast("timestamp") for column in zoneless})
