"""Registered queries: a Spark function and, where SQL can say it, its DuckDB twin."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tape import tape_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
TAPE = "WITH " + tape_sql(True)


def query(name: str, oracle: str | None = None):
    """Register the function under ``name``."""

    def keep(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return keep


def r8(c: str | Column, places: int = 8) -> Column:
    return F.round((F.col(c) if isinstance(c, str) else c).cast("double"), places)


def named(df: DataFrame, keys: list[str], longs: list[str] = (), ratios: list[str] = (), places: int = 8) -> DataFrame:
    """Keys as they are, ``longs`` as bigint, ``ratios`` as rounded doubles."""
    return df.select(*keys, *(F.col(c).cast("bigint").alias(c) for c in longs), *(r8(c, places).alias(c) for c in ratios))
