"""Which row of a key counts. A DataFrame has no order, so every function takes the column that gives it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROW = "_row_id"


def first_row_by(df: DataFrame, keys: list[str], order: str = ROW) -> DataFrame:
    """The first row of each key as it stands, empty fields included; rows with a null key are left out.

    One aggregation with map-side combination instead of a sort per key.
    """
    rest = [c for c in df.columns if c not in keys]
    known = df.dropna(subset=keys)
    picked = known.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r"))
    return picked.select(*keys, "_r.*").select(*df.columns)


def last_row_by(df: DataFrame, keys: list[str], order: str = ROW) -> DataFrame:
    """The last row of each key; rows with a null key are left out."""
    rest = [c for c in df.columns if c not in keys]
    picked = df.dropna(subset=keys).groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r"))
    return picked.select(*keys, "_r.*").select(*df.columns)


def first_filled_by(df: DataFrame, keys: list[str], fields: list[str], order: str = ROW) -> DataFrame:
    """Per key and field the first value that is not NULL; a field never filled stays NULL."""
    at = [F.min_by(F.when(F.col(f).isNotNull(), F.col(f)), F.when(F.col(f).isNotNull(), F.col(order))).alias(f) for f in fields]
    return df.dropna(subset=keys).groupBy(*keys).agg(*at)


def richest_by(df: DataFrame, keys: list[str], fields: list[str], tie: str) -> DataFrame:
    """The row of each key with most filled fields, of those the one with the smallest tie value."""
    filled = sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))
    rest = [c for c in df.columns if c not in keys]
    picked = df.dropna(subset=keys).groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct((-filled).alias("a"), F.col(tie).alias("b"))).alias("_r"))
    return picked.select(*keys, "_r.*").select(*df.columns)


def best_by(df: DataFrame, keys: list[str], score: str, order: str = ROW, above: float | None = None) -> DataFrame:
    """The row of each key with the highest score, the first of equals; only scores of at least `above` count."""
    rest = [c for c in df.columns if c not in keys]
    rows = df.dropna(subset=[*keys, score])
    if above is not None:
        rows = rows.where(F.col(score) >= above)
    picked = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct((-F.col(score)).alias("a"), F.col(order).alias("b"))).alias("_r"))
    return picked.select(*keys, "_r.*").select(*df.columns)


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key stands on more than one row."""
    many = df.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").drop("_n")
    return df.join(many, keys, "left_semi")
