"""Boilerplate lines by site-relative frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm.common import stage

RATIO = 0.05
LEAST_PAGES = 5


def _lines(text) -> object:
    return F.split(text, "\n", -1)


def boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """host_key, dropped: per host the hashes of the lines that more than `ratio` of its pages contain.

    A host has fewer than (mean lines per page / ratio) such lines, so a row stays small whatever the host's size.
    Counts are combined before the shuffle, keyed by host and line, so a host with most rows spreads over all tasks.
    """
    pages = docs.select(_host_key(host).alias("host_key"), F.col("text").cast("string").alias("text"))
    totals = pages.groupBy("host_key").agg(F.count("*").alias("pages"))
    distinct = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), lambda x: F.trim(x) != ""), lambda x: F.xxhash64(x)))
    counts = pages.select("host_key", F.explode(distinct).alias("line")).groupBy("host_key", "line").agg(F.count("*").alias("n"))
    often = counts.where(F.col("n") >= least_pages).join(totals, "host_key").where(F.col("n") > ratio * F.col("pages"))
    return often.groupBy("host_key").agg(F.collect_set("line").alias("dropped"))


def _host_key(host: str):
    return F.coalesce(F.concat(F.lit("="), F.col(host).cast("string")), F.lit("null"))


def drop_lines(docs: DataFrame, host: str = "source", ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> DataFrame:
    """docs with boilerplate lines removed from text, and n_lines, n_dropped; other columns stay as they are.

    A line is what stands between newlines, compared exactly by its 64-bit hash. It goes where more than `ratio` of
    its host's pages hold it and at least `least_pages` do; a page counts once however often it repeats the line.
    Blank lines never count and always stay. Every row is a page, repeated rows and null texts included; a null host
    is a host of its own. A null text stays null with 0 lines; a text whose lines all go becomes empty. No row is lost.
    The table of dropped lines is staged first, so its size is known when the plan chooses broadcast or shuffle.
    """
    dropped = stage(boilerplate(docs, host, ratio, least_pages))
    own = [docs[c] for c in docs.columns if c not in ("n_lines", "n_dropped", "text")]
    keyed = docs.select(*own, F.col("text").cast("string").alias("text"), _host_key(host).alias("_host_key"))
    joined = keyed.join(dropped, keyed["_host_key"] == dropped["host_key"], "left")
    gone = F.coalesce(F.col("dropped"), F.array().cast("array<bigint>"))
    left = F.filter(_lines(F.col("text")), lambda x: (F.trim(x) == "") | ~F.array_contains(gone, F.xxhash64(x)))
    size = F.coalesce(F.size(_lines(F.col("text"))), F.lit(0)).cast("long")
    out = joined.withColumn("_left", left).withColumn("n_lines", F.when(F.col("text").isNull(), F.lit(0)).otherwise(size).cast("long"))
    out = out.withColumn("n_dropped", F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("_left")).cast("long"))
    out = out.withColumn("text", F.when(F.col("n_dropped") == 0, F.col("text")).otherwise(F.array_join("_left", "\n")))
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    return out.select(*names, "n_lines", "n_dropped")


def oracle(ratio: float = RATIO, least_pages: int = LEAST_PAGES) -> str:
    """The same over table documents in DuckDB."""
    return f"""
WITH pages AS (SELECT doc_id, coalesce('=' || source, 'null') AS h, text, string_split(text, chr(10)) AS ls FROM documents),
totals AS (SELECT h, count(*) AS pages FROM pages GROUP BY h),
parts AS (SELECT h, unnest(list_distinct(list_filter(ls, lambda x: trim(x) <> ''))) AS line FROM pages),
counts AS (SELECT h, line, count(*) AS n FROM parts GROUP BY h, line),
bad AS (SELECT c.h, list(line) AS lines FROM counts c JOIN totals t ON c.h = t.h WHERE n >= {least_pages} AND n > {ratio} * pages GROUP BY c.h),
kept AS (SELECT p.*, list_filter(ls, lambda x: trim(x) = '' OR NOT list_contains(coalesce(lines, []), x)) AS rest
         FROM pages p LEFT JOIN bad b ON p.h = b.h)
SELECT doc_id, coalesce(len(ls), 0)::BIGINT AS n_lines, coalesce(len(ls) - len(rest), 0)::BIGINT AS n_dropped,
       CASE WHEN text IS NULL THEN NULL ELSE array_to_string(rest, chr(10)) END AS text FROM kept
"""
