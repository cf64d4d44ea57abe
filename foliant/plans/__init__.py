"""Registered queries: each operator over the driver's tables, with the DuckDB SQL of the same result where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function (spark, sf_dir) under its name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str, spread: bool = False) -> DataFrame:
    """A table; spread deals its rows evenly to all cores first, for work on rows that outweighs a shuffle of them.

    A scan has at most as many tasks as its files have row groups, which for a small file may be one. From a size on that
    gives every core a split of its own, the scan is left as it is.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if spread and df.rdd.getNumPartitions() < cores else df


def every() -> tuple[dict, dict]:
    from foliant.plans import assembly, graph, linking, profiling, relational, scalar

    del assembly, graph, linking, profiling, relational, scalar
    return QUERIES, ORACLES
