"""Where queries and their SQL checks are collected."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name``; ``sql`` is its check on the same tables."""
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give CPU-heavy queries every core when the file has fewer splits.

    The given tables are single small files; a table of many splits is
    returned as it is.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(wanted, *keys) if df.rdd.getNumPartitions() < wanted else df
