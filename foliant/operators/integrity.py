"""Damaged text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliant.nulls import col

#: Letters that Windows-1252 has for bytes 0x80 to 0x9F.
WINDOWS_HIGH = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CONTINUED = f"[\u0080-¿{WINDOWS_HIGH}]"
DOUBLE = f"[ÃÂ]{CONTINUED}|â€{CONTINUED}"
CONTROL = r"[\x{0}-\x{8}\x{b}\x{c}\x{e}-\x{1f}\x{7f}-\x{9f}]"
LITERAL = r'(?s)^\s*"(.*)"(@[A-Za-z]{2,3}(-[A-Za-z0-9]+)*|\^\^<[^>]+>)\s*\z'


def issues(c: Column | str, valid_utf8: Column | None = None) -> Column:
    """Issues of a text: replacement_char, double_encoded, control_char, serialised_rdf_literal; NULL and empty have none.

    With a flag for the source line's UTF-8, invalid_utf8 stands first and takes the place of replacement_char.
    """
    c = col(c)
    valid = F.lit(True) if valid_utf8 is None else valid_utf8
    found = F.array(
        F.when(~valid, "invalid_utf8"),
        F.when(valid & c.contains("�"), "replacement_char"),
        F.when(c.rlike(DOUBLE), "double_encoded"),
        F.when(c.rlike(CONTROL), "control_char"),
        F.when(c.rlike(LITERAL), "serialised_rdf_literal"),
    )
    return F.array_compact(found)


def unwrap_literal(c: Column | str) -> Column:
    c = col(c)
    return F.when(c.rlike(LITERAL), F.regexp_extract(c, LITERAL, 1)).otherwise(c)


def issue_counts(df: DataFrame, fields: list[str], key: str, examples: int = 3) -> DataFrame:
    """column_name, issue, n, examples: counts, and the smallest keys by which to look at rows.

    The keys are cut to `examples` per partial group by a ranked window over distinct keys of damaged rows only.
    """
    long = df.select(F.col(key).cast("string").alias("k"), F.inline(F.array(*[F.struct(F.lit(f).alias("column_name"), issues(F.col(f).cast("string")).alias("i")) for f in fields])))
    hit = long.select("k", "column_name", F.explode("i").alias("issue"))
    counts = hit.groupBy("column_name", "issue").agg(F.count("*").alias("n"))
    order = Window.partitionBy("column_name", "issue").orderBy("k")
    some = hit.distinct().withColumn("r", F.row_number().over(order)).where(F.col("r") <= examples)
    shown = some.groupBy("column_name", "issue").agg(F.array_join(F.array_sort(F.collect_list("k")), "; ").alias("examples"))
    return counts.join(shown, ["column_name", "issue"])
