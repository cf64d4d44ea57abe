"""One record per entity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.nulls import fold
from foliant.operators.firsts import ROW


def set_aggregate(df: DataFrame, key: str, fields: list[str], separator: str | None = "; ") -> DataFrame:
    """Per key the sorted distinct values of each field, joined by the separator (None: arrays). NULL where there is none."""
    sets = {f: F.array_sort(F.collect_set(f)) for f in fields}
    done = {f: s if separator is None else F.nullif(F.array_join(s, separator), F.lit("")) for f, s in sets.items()}
    return df.dropna(subset=[key]).groupBy(key).agg(*[c.alias(f) for f, c in done.items()])


def exact_duplicates(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, rows, duplicates: rows of a key that repeat another in all fields."""
    every = df.dropna(subset=[key]).groupBy(key, *fields).agg(F.count("*").alias("n"))
    return every.groupBy(key).agg(F.sum("n").alias("rows"), (F.sum("n") - F.count("*")).alias("duplicates"))


def variations(df: DataFrame, key: str, fields: list[str], order: str = ROW) -> DataFrame:
    """key, merge_count, varying: how often a later distinct row brought a new value to a filled field, and the fields.

    A value counts at its first row; the first value of a field is no variation.
    """
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("value")) for f in fields])
    long = df.dropna(subset=[key]).select(key, order, F.inline(pairs)).where("value IS NOT NULL")
    seen = long.groupBy(key, "field", "value").agg(F.min(order).alias("at"))
    start = seen.groupBy(key, "field").agg(F.min("at").alias("start"))
    new = seen.join(start, [key, "field"]).where("at > start")
    return new.groupBy(key).agg(F.count_distinct("at").alias("merge_count"), F.array_join(F.array_sort(F.collect_set("field")), "; ").alias("varying"))


def dedup_by_field(df: DataFrame, field: str, separator: str = ", ") -> DataFrame:
    """Rows of one value of the field become one, differing values joined. Rows without a value all become one as well."""
    rest = [c for c in df.columns if c != field]
    made = df.groupBy(field).agg(*[F.nullif(F.array_join(F.array_sort(F.collect_set(c)), separator), F.lit("")).alias(c) for c in rest])
    return made.select(*df.columns)


def field_statistics(df: DataFrame, fields: list[str]) -> DataFrame:
    """field, filled, fill_percent, items_per_record over a table with "; "-joined cells."""
    n = F.count("*").alias("n")
    per = [F.struct(F.lit(f).alias("field"), F.count(f).alias("filled"), F.sum(F.coalesce(F.size(F.filter(F.split(f, ";"), lambda x: F.trim(x) != "")), F.lit(0)) * F.col(f).isNotNull().cast("int")).alias("items")).alias(f) for f in fields]
    one = df.agg(n, *per)
    rows = one.select("n", F.inline(F.array(*fields)))
    return rows.select(
        "field", "filled", F.when(F.col("n") > 0, F.round(F.col("filled") / F.col("n") * 100, 4)).otherwise(0.0).alias("fill_percent"),
        F.when(F.col("n") > 0, F.round(F.col("items") / F.col("n"), 4)).otherwise(0.0).alias("items_per_record"),
    )


def with_any(df: DataFrame, fields: list[str]) -> DataFrame:
    """Rows that have a value in at least one of the fields."""
    return df.where(F.coalesce(*[fold(f) for f in fields]).isNotNull())
