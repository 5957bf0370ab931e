"""Scans of document tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def write_routed(df: DataFrame, path: str, routing: str = "_routing") -> None:
    """One folder per routing value, so that a routed read opens only its own. Rebalancing
    gathers a route's rows into few files and splits a heavy route by size, so no route is
    a single task's work."""
    df.hint("rebalance", routing).write.mode("error").partitionBy(routing).parquet(path)


def read_routed(spark: SparkSession, path: str, route: str, routing: str = "_routing"):
    return spark.read.parquet(path).where(F.col(routing) == route)
