"""Shared pieces of the training-data operators: process memory and connected components."""

from __future__ import annotations

import sys
from types import ModuleType

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.staging import stage

__all__ = ["components", "forget", "meet", "only", "process_memory", "stage", "tidy", "without"]


def forget() -> None:
    """Drop what earlier tasks of this worker process remembered; operators without such a memory begin with this."""
    home = sys.modules.get("_foliant_process_memory")
    if home is not None:
        for value in [v for v in vars(home).values() if isinstance(v, dict)]:
            value.clear()
        tidy()


def tidy() -> None:
    """Give freed memory back to the system at the end of a task, since the worker process lives on."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


BROADCAST_ROWS = 2_000_000


def only(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of df whose id is in ids (one long column of that name). The ids are counted first: up to BROADCAST_ROWS
    (some 16 MB) they are broadcast and df isn't shuffled, beyond that both sides are."""
    return df.join(F.broadcast(ids) if ids.count() <= BROADCAST_ROWS else ids, column, "left_semi")


def without(df: DataFrame, ids: DataFrame, column: str) -> DataFrame:
    """Rows of df whose id isn't in ids (one long column of that name), null ids included; ids are staged and counted as in only()."""
    gone = stage(ids.select(F.col(column).alias("_gone")).distinct())
    side = F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone
    return df.join(side, df[column].cast("long") == F.col("_gone"), "left_anti")


HOT = 1000


def meet(many: DataFrame, one: DataFrame, on: list[str], times: str | None = None) -> DataFrame:
    """many.join(one, on), where `one` has a row per key and a key may have any number of rows in `many` (staged tables).
    times names the column of `one` with that number, where it is known; it isn't returned.

    A key of over HOT rows is dealt over one task per HOT rows: its rows in `many` get a salt by their hash, its row of
    `one` is repeated once per salt. Hot keys are at most a HOT-th of the rows; they are counted before they are broadcast.
    """
    counts = many.groupBy(*on).agg(F.count("*").alias("_n")) if times is None else one.select(*on, F.col(times).alias("_n"))
    one = one if times is None else one.drop(times)
    many_rows = counts.where(F.col("_n") > HOT)
    if many_rows.isEmpty():
        return many.join(one, on)
    hot = stage(many_rows.select(*on, F.ceil(F.col("_n") / HOT).cast("int").alias("_salts")))
    n = hot.count()
    side = F.broadcast(hot) if n <= BROADCAST_ROWS else hot
    salts = F.coalesce("_salts", F.lit(1))
    left = many.join(side, on, "left").withColumn("_salt", F.pmod(F.xxhash64(*many.columns), salts).cast("int")).drop("_salts")
    right = one.join(side, on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("_salts")
    return left.join(right, [*on, "_salt"]).drop("_salt")


def process_memory(name: str) -> dict:
    """A dictionary that lasts as long as the worker process, so that later tasks find what earlier ones looked up."""
    home = sys.modules.setdefault("_foliant_process_memory", ModuleType("_foliant_process_memory"))
    return home.__dict__.setdefault(name, {})


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an edge list by alternating large-star and small-star rounds.

    edges: columns a, b (long); self-links, repeated links and nulls are allowed and ignored.
    Returns node, label: one row per node that has a link, label being the smallest node of its component.
    Every round is an aggregation with map-side minima and one join, staged in the shared folder; nothing is collected but two numbers.
    """
    e = stage(
        edges.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct()
    )
    seen = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stage(large.where("u != v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        small = joined.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = stage(small.unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct())
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == seen:
            break
        seen = now
    out = e.groupBy("u").agg(F.min("v").alias("label")).withColumnRenamed("u", "node")
    roots = out.select(F.col("label").alias("node")).distinct().withColumn("label", F.col("node"))
    return stage(out.unionByName(roots))
