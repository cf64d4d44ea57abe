from __future__ import annotations

import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from foliant.session import session

    folder = tempfile.mkdtemp(prefix="foliant-tests-")
    s = session(
        "local[4]", "tests", spark__sql__shuffle__partitions="4", spark__driver__memory="4g", spark__checkpoint__dir=folder,
        spark__ui__showConsoleProgress="false",
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_dir() -> str:
    return SF


@pytest.fixture
def values(spark):
    """Evaluate a column expression over (id, v) rows; returns the list of results in order."""
    from pyspark.sql import functions as F

    def run(items, made, schema="id int, v string"):
        d = spark.createDataFrame([(i, x) for i, x in enumerate(items)], schema)
        return [r["o"] for r in d.select("id", made(F.col("v")).alias("o")).orderBy("id").collect()]

    return run
