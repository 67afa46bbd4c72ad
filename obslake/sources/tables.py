"""File-table helpers on the cluster's shared storage.

Everything obslake writes for itself (landing zones in tests, stream
checkpoints, versioned tables) goes under the shared folder named by
``spark.checkpoint.dir``.  That setting is read from the session; a
machine-local folder is only created when it is unset (tests, bench).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if d is None:
        d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
        if d is None:
            # A machine-local folder is only valid when driver and executors
            # share the machine (local mode: tests, bench).
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
            d = tempfile.mkdtemp(prefix="obslake-")
            spark.conf.set("spark.checkpoint.dir", d)
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


# Fixed value: HotSpot interprets methods of more bytes than this for good.
COMPILED_BYTES = 8000


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Actions inside run wide projections (a response built or parsed field
    by field) as small generated methods: fused into one method of more than
    ``COMPILED_BYTES`` they are never compiled by the JVM.  The session's own
    limit is put back."""
    key = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(int(before), COMPILED_BYTES)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def children(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(name, bytes, modification time) of what a folder holds, one listing;
    nothing when it does not exist."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    return sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(hpath))


def mkdirs(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(hpath)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a marker folder of our own, if it is there."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hpath, True)
