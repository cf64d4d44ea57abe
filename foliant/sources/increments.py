"""What is missing and what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def missing_years(spark, have: DataFrame, year: str, low: int, high: int) -> DataFrame:
    """year: the years of the range that the table lacks."""
    wanted = spark.range(low, high + 1).select(F.col("id").cast("int").alias("year"))
    return wanted.join(have.select(F.col(year).cast("int").alias("year")).distinct(), "year", "left_anti")


def start_year(have: DataFrame, year: str, first: int) -> int:
    """Where to go on: the last year present, which may be incomplete and is done again."""
    return have.agg(F.max(F.col(year).cast("int"))).first()[0] or first


def failed_in_log(log: DataFrame, pattern: str, done: DataFrame | None = None, value: str = "value") -> DataFrame:
    """key: what the log names as failed and the recovered table lacks."""
    k = log.select(F.regexp_extract(value, pattern, 1).alias("key")).where("key != ''").distinct()
    return k if done is None else k.join(done.select("key"), "key", "left_anti")


def appended(dimension: DataFrame, seen: DataFrame, key: str, order: str) -> DataFrame:
    """New keys numbered after the largest index of the dimension (key, idx), by first appearance; old numbers never change.

    Numbers are made within range partitions and shifted by the counts before them.
    """
    new = seen.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(order).alias("_first")).join(dimension.select(key), key, "left_anti")
    top = dimension.agg(F.max("idx")).first()[0] or 0
    part = new.repartitionByRange("_first", key).withColumn("_p", F.spark_partition_id())
    own = part.withColumn("_r", F.row_number().over(Window.partitionBy("_p").orderBy("_first", key)))
    sizes = part.groupBy("_p").agg(F.count("*").alias("_c"))
    base = sizes.withColumn("_b", F.coalesce(F.sum("_c").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_b")
    return own.join(base, "_p").select(key, (F.lit(top) + F.col("_b") + F.col("_r")).cast("long").alias("idx"))


def distinct_actors(df: DataFrame, columns: list[str]) -> DataFrame:
    """actor: every name of the role columns once, trimmed."""
    return df.select(F.explode(F.array(*[F.trim(F.col(c).cast("string")) for c in columns])).alias("actor")).where("actor IS NOT NULL AND actor != ''").distinct()
