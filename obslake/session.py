"""Session for tests and the bench (a cluster job gets its session from
the caller; operators never depend on the session zone)."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  zone: str = "UTC") -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="obslake-run-")
    # Local Python workers inherit the environment, not sys.path.
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    os.environ["PYTHONPATH"] = os.pathsep.join(
        p for p in (root, os.environ.get("PYTHONPATH", "")) if p)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("obslake")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", zone)
        .config("spark.driver.memory", os.environ.get("OBSLAKE_DRIVER_MEMORY", "8g"))
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/checkpoints")
        .config("spark.driver.extraJavaOptions", f"-Dderby.system.home={scratch}/derby")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
