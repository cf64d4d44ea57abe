"""Samples that come out the same on every run: rows are ordered by a hash of their key and a seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def seeded(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows, chosen by the MD5 of key|seed; a distributed top-n, no full sort."""
    return df.orderBy(F.md5(F.concat(F.col(key).cast("string"), F.lit(f"|{seed}"))), key).limit(n)


def seeded_entities(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """All rows of n distinct entities."""
    chosen = seeded(df.select(key).dropna().distinct(), key, n, seed)
    return df.join(chosen, key, "left_semi")


def fewest_gaps(df: DataFrame, fields: list[str], n: int, order: str) -> DataFrame:
    """n rows in order, from those with at most k empty fields, k as small as gives n rows (all rows if none does).

    Counts per number of gaps come to the driver: at most one row per field.
    """
    gaps = sum((F.col(f).isNull().cast("int") for f in fields), F.lit(0))
    counted = df.withColumn("gaps", gaps)
    have, most = 0, len(fields)
    for r in sorted(counted.groupBy("gaps").count().collect(), key=lambda r: r["gaps"]):
        have += r["count"]
        if have >= n:
            most = r["gaps"]
            break
    return counted.where(F.col("gaps") <= most).orderBy(order).limit(n)


def spaced_values(df: DataFrame, field: str, k: int) -> DataFrame:
    """k values evenly spaced over the sorted distinct ones: those at floor(i * n / k); all if there are fewer.

    Ranks are made per range partition and shifted by the counts before it, so no task holds all values.
    """
    values = df.select(F.col(field).cast("string").alias("value")).where("value IS NOT NULL").distinct()
    part = values.repartitionByRange(F.lower("value"), "value").withColumn("p", F.spark_partition_id())
    own = part.withColumn("r", F.row_number().over(Window.partitionBy("p").orderBy(F.lower("value"), "value")))
    sizes = part.groupBy("p").agg(F.count("*").alias("c"))
    before = sizes.withColumn("base", F.coalesce(F.sum("c").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    total = values.count()
    ranked = own.join(before.select("p", "base"), "p").withColumn("i", F.col("base") + F.col("r") - 1)
    chosen = ranked if total <= k else ranked.where(F.col("i").isin([i * total // k for i in range(k)]))
    return chosen.select("value").orderBy(F.lower("value"), "value")
