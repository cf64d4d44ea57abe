"""Results to files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.nulls import at_sink, with_columns


def write_csv(df: DataFrame, path: str, columns: list[str] | None = None, quote_all: bool = False) -> None:
    """Header and the named columns only, NULL as empty text, quotes doubled."""
    out = with_columns(df, columns).select(*columns) if columns else df
    at_sink(out).write.mode("overwrite").csv(path, header=True, escape='"', quoteAll=quote_all, emptyValue="")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def split_outputs(df: DataFrame, kind: str, groups: dict[str, tuple[str, ...]], folder: str, public: list[str]) -> None:
    """One output per group of kinds with the public columns, and the full table."""
    df.write.mode("overwrite").parquet(f"{folder}/full")
    full = df.sparkSession.read.parquet(f"{folder}/full")
    for name, kinds in groups.items():
        full.where(F.col(kind).isin(*kinds)).select(*public).write.mode("overwrite").parquet(f"{folder}/{name}")


def replace_table(df: DataFrame, path: str) -> None:
    """Write beside the table, then swap: readers see the old table or the new one. Uses the store's own rename."""
    spark = df.sparkSession
    df.write.mode("overwrite").parquet(f"{path}.new")
    jvm = spark.sparkContext._jvm
    new, old, here = (jvm.org.apache.hadoop.fs.Path(p) for p in (f"{path}.new", f"{path}.old", path))
    fs = here.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(old, True)
    if fs.exists(here) and not fs.rename(here, old):
        raise OSError(f"can't move {path} away")
    if not fs.rename(new, here):
        raise OSError(f"can't move {path}.new into place")
    fs.delete(old, True)


def stamped(stem: str, extension: str, moment: str, **given: str) -> str:
    """A file name with its parameters and a time stamp; signs other than letters, digits, - and _ become _."""
    parts = [stem, *[f"{k}-{v}" for k, v in sorted(given.items())], moment]
    clean = ["".join(ch if ch.isalnum() or ch in "-_" else "_" for ch in p) for p in parts]
    return "_".join(clean) + "." + extension.lstrip(".")
