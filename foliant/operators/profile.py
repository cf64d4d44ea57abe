"""What a table holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.nulls import fold


def long_form(df: DataFrame, keys: list[str], fields: list[str], profile: str = "analysis") -> DataFrame:
    """keys, field, value: one row per field, values folded."""
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), fold(F.col(f).cast("string"), profile).alias("value")) for f in fields])
    return df.select(*keys, F.inline(pairs))


def value_counts(df: DataFrame, field: str) -> DataFrame:
    """value, n: most frequent first, equals by value."""
    return df.groupBy(F.col(field).cast("string").alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")


def grouped_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    """Rows per pair of values, sorted without regard to case."""
    n = df.groupBy(F.col(first).cast("string").alias("first"), F.col(second).cast("string").alias("second")).agg(F.count("*").alias("n"))
    return n.orderBy(F.lower("first"), "first", F.lower("second"), "second")


def profile(df: DataFrame, fields: list[str], top: int = 10) -> DataFrame:
    """field, total, filled, distinct_values, fill_rate, rank, value, n: the most frequent values of every field.

    Counts per value are made first; the rank then sorts distinct values only. Ties go by value.
    """
    counts = long_form(df, [], fields).groupBy("field", "value").agg(F.count("*").alias("n"))
    totals = counts.groupBy("field").agg(
        F.sum("n").alias("total"), F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("filled"), F.count("value").alias("distinct_values")
    )
    order = Window.partitionBy("field").orderBy(F.desc("n"), "value")
    ranked = counts.where("value IS NOT NULL").withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    out = totals.join(ranked, "field", "left").withColumn("fill_rate", F.round(F.col("filled") / F.col("total"), 4))
    return out.select("field", "total", "filled", "distinct_values", "fill_rate", "rank", "value", "n")


def field_cardinality(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """field, keys, mean_values: distinct values per key, over the keys that have any."""
    per = long_form(df, [key], fields).where("value IS NOT NULL").groupBy("field", key).agg(F.count_distinct("value").alias("c"))
    return per.groupBy("field").agg(F.count("*").alias("keys"), F.round(F.avg("c"), 4).alias("mean_values"))


def key_profiles(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, field, values: for keys on several rows the counted values of each field, most frequent first, as text."""
    many = df.groupBy(key).agg(F.count("*").alias("c")).where(F.col(key).isNotNull() & (F.col("c") > 1)).select(key)
    counts = long_form(df.join(many, key, "left_semi"), [key], fields, "strip").where("value IS NOT NULL").groupBy(key, "field", "value").agg(F.count("*").alias("n"))
    entry = F.struct((-F.col("n")).alias("neg"), "value")
    made = counts.groupBy(key, "field").agg(F.array_sort(F.collect_list(entry)).alias("e"))
    return made.select(key, "field", F.array_join(F.transform("e", lambda x: F.concat(x["value"], F.lit("="), (-x["neg"]).cast("string"))), "; ").alias("values"))


def mean_of_means(df: DataFrame, file: str, size: str) -> DataFrame:
    """files, mean: the mean over files of each file's mean size, not the pooled mean."""
    per = df.groupBy(file).agg(F.avg(size).alias("m"))
    return per.agg(F.count("*").alias("files"), F.round(F.avg("m"), 6).alias("mean"))


def distinct_values(df: DataFrame, fields: list[str]) -> DataFrame:
    """field, value: every distinct value, sorted without regard to case."""
    return long_form(df, [], fields, "strip").where("value IS NOT NULL").distinct().orderBy("field", F.lower("value"), "value")


def merged_counts(lists: DataFrame, key: str, value: str, n: str, member: str) -> DataFrame:
    """key, members, total: counted values merged over files, for keys with several members."""
    return lists.groupBy(key).agg(F.count_distinct(member).alias("members"), F.sum(n).alias("total")).where("members > 1")


def column_catalogue(headers: DataFrame) -> DataFrame:
    """column_name, files: from file, columns(array), which files have a column."""
    long = headers.select("file", F.explode("columns").alias("column_name"))
    return long.groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_set("file")), "; ").alias("files"))


def schema_groups(headers: DataFrame) -> DataFrame:
    """names, n_columns, files, n_files: the files that have the same columns, in whatever order."""
    d = headers.select("file", F.array_sort(F.array_distinct("columns")).alias("c"))
    per = d.groupBy("c").agg(F.array_sort(F.collect_list("file")).alias("f"))
    return per.select(F.array_join("c", "; ").alias("names"), F.size("c").cast("long").alias("n_columns"), F.array_join("f", "; ").alias("files"), F.size("f").cast("long").alias("n_files"))


def filled_entities(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """field, n: distinct keys with a value in the field, on any of their rows; one shuffle for all fields."""
    per = df.groupBy(key).agg(*[F.max(fold(F.col(f).cast("string"), "strip").isNotNull()).alias(f) for f in fields])
    totals = per.where(F.col(key).isNotNull()).agg(*[F.count_if(f).alias(f) for f in fields])
    return totals.select(F.inline(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("n")) for f in fields])))
