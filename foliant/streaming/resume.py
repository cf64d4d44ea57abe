"""Keyed appends that can be interrupted at any point."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException


def append_new(spark: SparkSession, todo: DataFrame, key: str, path: str, work: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Do the work for keys that the Parquet table at path lacks, append the results and return the table.

    A task's output appears as a whole or not at all, so a second run finishes what a first one left.
    """
    try:
        done = spark.read.parquet(path).select(key).distinct()
        todo = todo.join(done, key, "left_anti")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    work(todo).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def follow(spark: SparkSession, source: str, schema: str, key: str, target: str, checkpoint: str, work: Callable[[DataFrame], DataFrame]):
    """A stream over new files of a folder, each batch handled like append_new; the checkpoint makes it exactly-once by key."""

    def batch(df: DataFrame, _: int) -> None:
        append_new(df.sparkSession, df.dropDuplicates([key]), key, target, work)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()


def windowed_counts(events: DataFrame, time: str, kind: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """start, kind, n per tumbling window; as a stream, rows later than the watermark are dropped. An extension: the catalogue has no streams."""
    w = events.withWatermark(time, late) if events.isStreaming else events
    return w.groupBy(F.window(time, width).alias("w"), kind).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), kind, "n")
