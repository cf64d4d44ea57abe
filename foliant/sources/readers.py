"""Text tables, archives and file names. Paths go to Spark's readers, so any store that Spark reads will do."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.functions.years import years_of_path
from foliant.nulls import with_columns
from foliant.operators.firsts import ROW

FILES = "path string, member string, extension string, header array<string>, row_no long, cells array<string>"


def read_csv(spark: SparkSession, path: str | list[str], columns: list[str] | None = None, separator: str = ",", encoding: str = "UTF-8") -> DataFrame:
    """Strings only, quotes doubled inside quotes, cells over several lines; _row_id in file order, _path.

    With columns given, missing ones are NULL and the rest come after. Row ids ascend within a file as Spark splits it.
    """
    df = spark.read.csv(path, header=True, multiLine=True, escape='"', sep=separator, encoding=encoding, inferSchema=False)
    df = df.select("*", F.col("_metadata.file_path").alias("_path"), F.monotonically_increasing_id().alias(ROW))
    return with_columns(df, columns) if columns else df


def sniff(spark: SparkSession, path: str, size: int = 4096) -> tuple[str, str]:
    """Separator and encoding of a text table, from its first bytes: a probe of one file that reaches the driver."""
    head = spark.read.format("binaryFile").load(path).select(F.substring("content", 1, size).alias("c")).first()["c"]
    encoding = "UTF-8"
    try:
        text = bytes(head).decode("utf-8-sig")
    except UnicodeDecodeError as e:
        if e.start > len(head) - 4:
            text = bytes(head[: e.start]).decode("utf-8-sig")
        else:
            text, encoding = bytes(head).decode("latin-1"), "ISO-8859-1"
    try:
        separator = csv.Sniffer().sniff(text, ",;\t|").delimiter
    except csv.Error:
        separator = ","
    return separator, encoding


def _members(path: str, data: bytes) -> Iterator[tuple[str, bytes]]:
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        for info in z.infolist():
            if info.is_dir():
                continue
            inner = z.read(info)
            if info.filename.lower().endswith(".zip"):
                for name, part in _members(info.filename, inner):
                    yield f"{info.filename}/{name}", part
            else:
                yield info.filename, inner


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """One row per file in ZIP archives, nested ones too, and per record of their CSV files (cells NULL for other files).

    path, member, extension, header, row_no, cells. Archives are read by one task each, as the format demands.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["path", "member", "extension", "header", "row_no", "cells"]
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"], strict=True):
                for member, data in _members(path, bytes(content)):
                    extension = member.rsplit(".", 1)[-1].lower() if "." in member.rsplit("/", 1)[-1] else ""
                    if extension != "csv":
                        yield pd.DataFrame([(path, member, extension, None, None, None)], columns=names)
                        continue
                    rows = csv.reader(io.StringIO(data.decode("utf-8-sig", errors="replace"), newline=""))
                    header = next(rows, [])
                    part = []
                    for i, cells in enumerate(rows):
                        part.append((path, member, extension, header, i, cells))
                        if len(part) == 5000:
                            yield pd.DataFrame(part, columns=names)
                            part = []
                    yield pd.DataFrame(part or [(path, member, extension, header, None, None)], columns=names)

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, FILES)


def archive_table(archives: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns of all CSV records of read_archives, with __internal_csv_path; absent columns are NULL."""
    at = lambda c: F.try_element_at("cells", F.array_position("header", c).cast("int"))
    d = archives.where("cells IS NOT NULL")
    return d.select(*[F.when(F.array_contains("header", c), at(c)).alias(c) for c in columns], F.col("member").alias("__internal_csv_path"), F.col("row_no").alias(ROW))


def archive_tree(archives: DataFrame) -> DataFrame:
    """extension, files."""
    return archives.select("path", "member", "extension").distinct().groupBy("extension").agg(F.count("*").alias("files"))


def in_years(df: DataFrame, path: str, years: list[int]) -> DataFrame:
    """Rows from files whose path names one of the years."""
    return df.where(F.arrays_overlap(years_of_path(path), F.array(*[F.lit(str(y)) for y in years])))


def named(df: DataFrame, path: str, text: str) -> DataFrame:
    """Rows from files whose name holds the text, regardless of case."""
    return df.where(F.lower(F.element_at(F.split(path, "/"), -1)).contains(text.lower()))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, valid_utf8: lines with damaged bytes replaced, and whether there were any."""
    raw = spark.read.text(path).select(F.col("value").cast("binary").alias("b"), "value")
    return raw.select(F.make_valid_utf8("value").alias("value"), F.is_valid_utf8("value").alias("valid_utf8"))
