"""N-Triples text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.nulls import col

LINE = (
    r'^\s*(<[^\x00-\x20<>"{}|^`\\]+>|_:\S+)\s+<[^\x00-\x20<>"{}|^`\\]+>\s+'
    r'(<[^\x00-\x20<>"{}|^`\\]+>|_:\S+|"([^"\\\r\n]|\\[tbnrf"\'\\]|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8})*"'
    r'(@[A-Za-z]+(-[A-Za-z0-9]+)*|\^\^<[^\x00-\x20<>"{}|^`\\]+>)?)\s*\.\s*(#.*)?\z'
)


def escaped(c: Column | str) -> Column:
    out = col(c)
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def lines(t: DataFrame) -> DataFrame:
    """value: one line per triple."""
    literal = F.concat(F.lit('"'), escaped("o"), F.lit('"'), F.when(F.col("datatype").isNotNull() & ~F.col("datatype").endswith("#string"), F.concat(F.lit("^^<"), F.col("datatype"), F.lit(">"))).otherwise(""))
    o = F.when(F.col("kind") == "iri", F.concat(F.lit("<"), F.col("o"), F.lit(">"))).otherwise(literal)
    return t.select(F.concat(F.lit("<"), F.col("s"), F.lit("> <"), F.col("p"), F.lit("> "), o, F.lit(" .")).alias("value"))


def valid(c: Column | str) -> Column:
    """Blank lines and comments are valid too."""
    return col(c).rlike(LINE) | col(c).rlike(r"^\s*(#.*)?\z")


def bad_lines(df: DataFrame, value: str = "value", most: int = 50) -> DataFrame:
    """Up to `most` lines that don't parse: a report, cut by intent."""
    return df.where(~valid(value)).limit(most)


def write(t: DataFrame, path: str) -> None:
    lines(t).write.mode("overwrite").text(path)


def parse(df: DataFrame, value: str = "value") -> DataFrame:
    """s, p, o, kind, datatype of valid lines whose subject and predicate are IRIs."""
    pat = r'^\s*<([^>]*)>\s+<([^>]*)>\s+(?:<([^>]*)>|"((?:[^"\\]|\\.)*)"(?:\^\^<([^>]*)>|@\S+)?)\s*\.\s*(#.*)?\z'
    g = lambda i: F.regexp_extract(F.col(value), pat, i)
    text = g(4)
    for a, b in (("\\t", "\t"), ("\\r", "\r"), ("\\n", "\n"), ('\\"', '"'), ("\\\\", "\\")):
        text = F.replace(text, F.lit(a), F.lit(b))
    d = df.where(F.col(value).rlike(pat))
    return d.select(g(1).alias("s"), g(2).alias("p"), F.when(g(3) != "", g(3)).otherwise(text).alias("o"), F.when(g(3) != "", "iri").otherwise("literal").alias("kind"), F.nullif(g(5), F.lit("")).alias("datatype"))
