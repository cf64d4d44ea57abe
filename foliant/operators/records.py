"""Record types, works and links of editions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.nulls import col
from foliant.operators.firsts import ROW, first_row_by


def items(c: Column | str, separator: str = ";") -> Column:
    """Distinct non-empty parts of a cell, in order; an empty array for NULL."""
    parts = F.array_distinct(F.filter(F.transform(F.split(col(c), separator), lambda x: F.trim(x)), lambda x: x != ""))
    return F.coalesce(parts, F.array().cast("array<string>"))


def type_counts(df: DataFrame, types: str) -> DataFrame:
    """type, n: rows with the type, once per row (types: array)."""
    return df.select(F.explode(F.array_distinct(types)).alias("type")).groupBy("type").agg(F.count("*").alias("n"))


def type_cardinality(df: DataFrame, types: str) -> DataFrame:
    """n_types, rows."""
    return df.groupBy(F.size(F.array_distinct(types)).cast("long").alias("n_types")).agg(F.count("*").alias("rows"))


def without_type(df: DataFrame, types: str, entities: str) -> DataFrame:
    """entity: distinct entities of rows without any type (entities: array)."""
    return df.where(F.coalesce(F.size(types), F.lit(0)) == 0).select(F.explode(entities).alias("entity")).distinct()


def only_types(df: DataFrame, key: str, types: str, allowed: list[str], order: str = ROW) -> DataFrame:
    """Rows of keys whose first row has types, all of them allowed."""
    first = first_row_by(df.select(key, types, order), [key], order)
    good = first.where((F.size(types) > 0) & (F.size(F.array_except(types, F.array(*[F.lit(a) for a in allowed]))) == 0)).select(key)
    return df.join(good, key, "left_semi")


def of_type(df: DataFrame, types: str, wanted: str) -> DataFrame:
    return df.where(F.exists(types, lambda x: F.lower(x) == wanted.lower()))


def link_summary(df: DataFrame, work: str, edition: str, expression: str) -> DataFrame:
    """One row of distinct counts: works, editions and expressions that stand on rows with a work."""
    linked = F.col(work).isNotNull()
    return df.agg(
        F.count_distinct(work).alias("works"),
        F.count_distinct(edition).alias("editions"),
        F.count_distinct(F.when(linked, F.col(edition))).alias("editions_linked"),
        F.count_distinct(F.when(linked, F.col(expression))).alias("expressions_linked"),
    )


def missing_links(mine: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """keys: the distinct links of one table that the other lacks; null equals null."""
    return mine.select(*keys).subtract(other.select(*keys))


def one_to_many(df: DataFrame, one: str, many: str) -> DataFrame:
    """n, keys: how many keys have how many distinct partners."""
    per = df.dropna(subset=[one, many]).groupBy(one).agg(F.count_distinct(many).alias("n"))
    return per.groupBy("n").agg(F.count("*").alias("keys"))


def co_occurring(df: DataFrame, cell: str) -> DataFrame:
    """a, b, n: pairs of values of one cell (array), a < b, and the rows that hold both. A cell is expanded, never a group of rows."""
    a = df.select(F.array_sort(F.array_distinct(cell)).alias("v")).where(F.size("v") > 1)
    left = a.select("v", F.posexplode("v").alias("i", "a"))
    return left.select("a", F.explode(F.slice("v", F.col("i") + 2, F.size("v"))).alias("b")).groupBy("a", "b").agg(F.count("*").alias("n"))
