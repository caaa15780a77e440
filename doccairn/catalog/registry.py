"""Registration of queries and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register the function under its own name, with ``sql`` as its check if given."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def settled_decimals(column: Column, digits: int = 6) -> Column:
    """Half-up rounding built from operations both engines evaluate alike."""
    scale = float(10**digits)
    return F.floor(column * scale + 0.5) / F.lit(scale)


def sql_decimals(expression: str, digits: int = 6) -> str:
    scale = f"CAST({10**digits} AS DOUBLE)"
    return f"floor(({expression}) * {scale} + 0.5) / {scale}"
