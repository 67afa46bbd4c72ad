"""Stored keys as a bucketed table, for business keys without the fetch time.

Such a key can match a row of any day, so every append has to look at all
stored keys.  They are kept beside the facts, bucketed by the key: an append
shuffles its own rows into as many partitions as there are buckets and joins
bucket by bucket, while the stored side, which is larger by far, is read as it
lies and never exchanged.

The files are Parquet under ``<target>_keys/v<n>-<buckets>``; the bucket
layout is declared to the session's catalog when the table is opened, so no
metastore has to outlive the session.  Facts are the truth: a marker is set
before facts are appended and removed when their keys are, and a table with
the marker, or with none of its versions, is built again from the facts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.sources import tables

BUCKETS = 64
_VERSION = re.compile(r"v(\d+)-(\d+)$")
MARKER, BUILT = "_unfinished", "_built"


def _root(target: str) -> str:
    return f"{target.rstrip('/')}_keys"


def _latest(spark: SparkSession, target: str) -> tuple[int, int] | None:
    """(version, buckets) of the newest finished version."""
    found = [tuple(map(int, m.groups())) for name, _, _ in tables.children(spark, _root(target))
             if (m := _VERSION.match(name))]
    done = [v for v in found if tables.exists(spark, f"{_root(target)}/v{v[0]}-{v[1]}/{BUILT}")]
    return max(done, default=None)


def _declare(spark: SparkSession, path: str, facts: DataFrame, keys: Sequence[str], buckets: int) -> str:
    """Name of the bucketed table over ``path`` in the session's catalog."""
    name = f"obslake_keys_{hashlib.md5(path.encode()).hexdigest()[:16]}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{k}` {facts.schema[k].dataType.simpleString()}" for k in keys)
        by = ", ".join(f"`{k}`" for k in keys)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({by}) INTO {buckets} BUCKETS "
                  f"LOCATION '{path}'")
    return name


def _write(keyed: DataFrame, name: str, keys: Sequence[str], buckets: int) -> None:
    # partitions by the hash of the buckets: one file a bucket
    keyed.select(*keys).repartition(buckets, *keys).write.insertInto(name)


def build(spark: SparkSession, target: str, facts: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> str:
    """A new version from all facts of the target; its table's name.  Also the
    way to fewer files, or to another number of buckets."""
    last = _latest(spark, target)
    version = f"v{last[0] + 1 if last else 1}-{buckets}"
    while tables.exists(spark, f"{_root(target)}/{version}"):  # left by a build that died
        n = int(_VERSION.match(version).group(1)) + 1
        version = f"v{n}-{buckets}"
    path = f"{_root(target)}/{version}"
    name = _declare(spark, path, facts, keys, buckets)
    known = facts
    for k in keys:
        known = known.where(F.col(k).isNotNull())
    _write(known, name, keys, buckets)
    tables.mkdirs(spark, f"{path}/{BUILT}")
    tables.remove(spark, f"{_root(target)}/{MARKER}")
    return name


def opened(spark: SparkSession, target: str, facts: DataFrame, keys: Sequence[str], buckets: int = BUCKETS) -> tuple[str, int]:
    """(table name, buckets) of the stored keys of ``target``; built from
    ``facts``, all its rows, where it is missing or unfinished."""
    last = _latest(spark, target)
    if last is None or tables.exists(spark, f"{_root(target)}/{MARKER}"):
        return build(spark, target, facts, keys, last[1] if last else buckets), last[1] if last else buckets
    name = _declare(spark, f"{_root(target)}/v{last[0]}-{last[1]}", facts, keys, last[1])
    spark.catalog.refreshTable(name)  # another session may have added to it
    return name, last[1]


def begin(spark: SparkSession, target: str) -> None:
    """Mark that facts are about to be appended."""
    tables.mkdirs(spark, f"{_root(target)}/{MARKER}")


def add(spark: SparkSession, target: str, name: str, new: DataFrame, keys: Sequence[str], buckets: int) -> None:
    """Add the keys of appended facts and remove the mark."""
    _write(new, name, keys, buckets)
    tables.remove(spark, f"{_root(target)}/{MARKER}")
