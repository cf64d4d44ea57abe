"""Session settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(master: str | None = None, app: str = "foliant", **conf: str) -> SparkSession:
    """A session with UTC, adaptive execution and skew-join handling; further settings as keyword arguments (dots as __)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    given = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    } | {k.replace("__", "."): v for k, v in conf.items()}
    for k, v in given.items():
        b = b.config(k, v)
    return b.getOrCreate()
