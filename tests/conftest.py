from __future__ import annotations

import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from litsieve.session import tune

    session = (
        SparkSession.builder.master("local[8]")
        .appName("litsieve-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="litsieve-warehouse-"))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.log.level", "ERROR")
        .getOrCreate()
    )
    yield tune(session)
    session.stop()


@pytest.fixture(scope="session")
def folder():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture
def one(spark):
    """Evaluate a column expression over single texts."""

    def run(texts, expression):
        from pyspark.sql import functions as F

        rows = [(i, t) for i, t in enumerate(texts)]
        df = spark.createDataFrame(rows, "i int, t string")
        out = df.select("i", expression(F.col("t")).alias("v")).collect()
        return [r.v for r in sorted(out)]

    return run
