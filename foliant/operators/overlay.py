"""Corrections laid over a table by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.operators.firsts import ROW, first_row_by

#: Kinds of name corrections that may change the table.
APPLIED = ("derived_from_first_last", "stripped_rdf_literal_tag")


def overlay_columns(df: DataFrame, key: str, *overlays: DataFrame) -> DataFrame:
    """New columns from overlays with one row per key; rows without one get NULL."""
    for o in overlays:
        df = df.join(o, key, "left")
    return df


def fill_or_replace(df: DataFrame, key: str, field: str, overlay: DataFrame, applied: tuple[str, ...] = APPLIED) -> DataFrame:
    """Fill an empty field, or replace it where it still equals the original that the correction was made for.

    overlay: key, original, harmonised, correction_type, one row per key; kinds outside `applied` change nothing.
    """
    o = overlay.where(F.col("correction_type").isin(*applied) & F.col("harmonised").isNotNull())
    o = o.select(F.col(key).alias("_k"), F.col("original").alias("_o"), F.col("harmonised").alias("_h"))
    joined = df.join(o, df[key] == F.col("_k"), "left")
    new = F.when(F.col(field).isNull() | (F.col(field) == F.col("_o")), F.coalesce("_h", field)).otherwise(F.col(field))
    return joined.withColumn(field, new).select(*df.columns)


def replace_by_field(df: DataFrame, key: str, fields: list[str], overlay: DataFrame) -> DataFrame:
    """Per (key, field) corrections: overlay key, field, harmonised; NULL corrections change nothing."""
    wide = overlay.where("harmonised IS NOT NULL").groupBy(F.col(key).alias("_k")).agg(
        *[F.min(F.when(F.col("field") == f, F.col("harmonised"))).alias(f"_{f}") for f in fields]
    )
    joined = df.join(wide, df[key] == F.col("_k"), "left")
    return joined.withColumns({f: F.coalesce(f"_{f}", f) for f in fields}).select(*df.columns)


def replace_by_value(df: DataFrame, key: str, fields: list[str], overlay: DataFrame) -> DataFrame:
    """Per (key, field, raw value) corrections: overlay key, field, original, harmonised.

    Each key's corrections come as one map, so the table is joined once however many fields there are.
    """
    o = overlay.where("harmonised IS NOT NULL AND original IS NOT NULL").groupBy(F.col(key).alias("_k"), "field", "original").agg(F.min("harmonised").alias("h"))
    maps = o.groupBy("_k").agg(F.map_from_entries(F.collect_list(F.struct(F.struct("field", "original"), "h"))).alias("_m"))
    joined = df.join(maps, df[key] == F.col("_k"), "left")
    new = {f: F.coalesce(F.try_element_at("_m", F.struct(F.lit(f).alias("field"), F.col(f).alias("original"))), F.col(f)) for f in fields}
    return joined.withColumns(new).select(*df.columns)


def patch_table(df: DataFrame, keys: list[str], plan: DataFrame, override: DataFrame, fields: list[str], guard: list[str]) -> DataFrame:
    """Reference-table patch: an override beats the plan, and a plan row applies only where the guard columns still hold.

    plan and override: keys, new_<field>; plan also old_<guard>. Returns df with a boolean column changed.
    """
    p = plan.select(*[F.col(k).alias(f"_p{k}") for k in keys], *[F.col(f"old_{g}").alias(f"_g{g}") for g in guard], *[F.col(f"new_{f}").alias(f"_n{f}") for f in fields], F.lit(True).alias("_plan"))
    o = override.select(*[F.col(k).alias(f"_q{k}") for k in keys], *[F.col(f"new_{f}").alias(f"_o{f}") for f in fields], F.lit(True).alias("_over"))
    j = df.join(p, [df[k].eqNullSafe(F.col(f"_p{k}")) for k in keys], "left").join(o, [df[k].eqNullSafe(F.col(f"_q{k}")) for k in keys], "left")
    holds = F.coalesce(F.col("_plan"), F.lit(False))
    for g in guard:
        holds = holds & F.col(g).eqNullSafe(F.col(f"_g{g}"))
    over = F.coalesce(F.col("_over"), F.lit(False))
    new = {f: F.when(over, F.col(f"_o{f}")).when(holds, F.col(f"_n{f}")).otherwise(F.col(f)) for f in fields}
    changed = F.lit(False)
    for f in fields:
        changed = changed | ~new[f].eqNullSafe(F.col(f))
    return j.withColumn("changed", changed).withColumns({f"_f{f}": c for f, c in new.items()}).select(
        *[F.col(f"_f{c}").alias(c) if c in fields else F.col(c) for c in df.columns], "changed"
    )


def coalesce_ids(df: DataFrame, key: str, column: str, source: DataFrame, source_column: str) -> DataFrame:
    """An identifier taken from another source where the row has none."""
    s = source.groupBy(F.col(key).alias("_k")).agg(F.min(source_column).alias("_v"))
    return df.join(s, df[key] == F.col("_k"), "left").withColumn(column, F.coalesce(column, "_v")).select(*df.columns)


def join_if_absent(df: DataFrame, key: str, source: DataFrame, columns: list[str], order: str = ROW) -> DataFrame:
    """The columns that df lacks, from the first row of each key of the source; NULL without one."""
    missing = [c for c in columns if c not in df.columns]
    if not missing:
        return df
    s = first_row_by(source.select(key, *missing, F.col(order).alias("_at")), [key], "_at").drop("_at")
    return df.join(s, key, "left")
