from __future__ import annotations

import os
import sys
import tempfile

import pytest

TESTS = os.path.dirname(os.path.abspath(__file__))
ROOT = os.path.dirname(TESTS)
sys.path.insert(0, ROOT)
# Python workers inherit the environment, not sys.path.
os.environ["PYTHONPATH"] = os.pathsep.join(
    p for p in (ROOT, TESTS, os.environ.get("PYTHONPATH", "")) if p)

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="obslake-test-")
    s = (
        SparkSession.builder.master("local[4]")
        .appName("obslake-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from obslake.sources import tables

    return lambda name: tables.scratch_path(spark, name)
