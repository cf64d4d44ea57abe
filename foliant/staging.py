"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session. Where it is unset, a local master (one machine) gets a folder of its own,
    removed at exit; a cluster gets an error, since its executors can't see each other's local folders."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or _own.get(spark.sparkContext.applicationId)
    if not folder:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")
        folder = _own[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="foliant-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


#: Folders made on one machine, by application.
_own: dict[str, str] = {}
#: While a table is staged, rows go to Python in batches of at most so many rows and bytes.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2000", "spark.sql.execution.arrow.maxBytesPerBatch": "16m"}
#: Staged paths with their file system and Hadoop path.
_made: dict[str, tuple] = {}


def folder_of(spark: SparkSession, prefix: str) -> str:
    """A new path in the shared folder, removed when the driver's process ends, or by release()."""
    path = os.path.join(shared_dir(spark), f"{prefix}-{uuid.uuid4().hex}")
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not _made:
        atexit.unregister(release)
        atexit.register(release)
    _made[path] = at.getFileSystem(spark._jsc.hadoopConfiguration()), at
    return path


def release(*paths: str) -> None:
    """Remove staged tables, by default all of this process: for long runs, once the results made from them are written."""
    for path in paths or tuple(_made):
        files, at = _made.pop(path)
        try:
            files.delete(at, True)
        except Exception as e:  # the file system may be gone before this process
            warnings.warn(f"{path} was not removed: {e}", stacklevel=2)


def stage(df: DataFrame) -> DataFrame:
    """Write df once as Parquet and return its reader: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = folder_of(spark, "stage")
    before = {k: spark.conf.get(k) for k in BATCH}
    try:
        for k, v in BATCH.items():
            spark.conf.set(k, v)
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    return spark.read.schema(df.schema).parquet(path)
