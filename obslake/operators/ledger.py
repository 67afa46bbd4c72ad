"""Hour ledger: which landed hours were loaded, and what is left to load.

The raw root has one folder per hour (``dt=../hour=..``).  The ledger is an
append-only table of the hours that were loaded, with the state of their files
at that time.  The plan compares three things per hour: whether the schedule
expects it (a sequence of hours, not a table), what is landed now, and what the
ledger says:

* ``missing``   expected, but not landed (fetch it again if the API allows)
* ``pending``   landed, not loaded yet
* ``relanded``  loaded, but its files are others now
* ``done``      loaded as it is

The state of the files is taken before the load, so files that land during a
load make the hour ``relanded``.  Loads are idempotent, so loading an hour
once too often is harmless.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake import schemas
from obslake.sources import tables

LEDGER = "dt DATE, hour STRING, n_files BIGINT, n_bytes BIGINT, changed_ms BIGINT, loaded_at TIMESTAMP"
STATE = ("n_files", "n_bytes", "changed_ms")
TO_LOAD = ("pending", "relanded")
_FOLDER = r"/dt=([^/]+)/hour=([^/]+)/[^/]+$"


def expected_hours(spark: SparkSession, first: _dt.datetime, last: _dt.datetime) -> DataFrame:
    """``dt, hour`` of every hour from that of ``first`` to that of ``last``
    (UTC wall clocks)."""
    at = [t.replace(minute=0, second=0, microsecond=0) for t in (first, last)]
    n = int((at[1] - at[0]).total_seconds()) // 3600 + 1
    hour = F.timestamp_add("HOUR", F.col("id"), F.lit(at[0].isoformat(sep=" ")).cast("timestamp_ntz"))
    return spark.range(max(n, 0)).select(F.to_date(hour).alias("dt"), F.lpad(F.hour(hour).cast("string"), 2, "0").alias("hour"))


def _days(spark: SparkSession, root: str, first: _dt.date, last: _dt.date) -> list[str]:
    lo, hi = f"dt={first.isoformat()}", f"dt={last.isoformat()}"
    return [f"{root.rstrip('/')}/{name}" for name, _, _ in tables.children(spark, root)
            if name.startswith("dt=") and lo <= name <= hi]


def landed_hours(spark: SparkSession, root: str, first: _dt.date, last: _dt.date) -> DataFrame:
    """``dt, hour`` and the state of their files for the landed hours of
    these days.  Only their folders are listed, and no file is opened."""
    days = _days(spark, root, first, last)
    if not days:
        return spark.createDataFrame([], "dt DATE, hour STRING, n_files BIGINT, n_bytes BIGINT, changed_ms BIGINT")
    # only the listing is read: the content column is pruned
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(days)
    return files.groupBy(F.regexp_extract("path", _FOLDER, 1).cast("date").alias("dt"),
                         F.regexp_extract("path", _FOLDER, 2).alias("hour")).agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"), F.unix_millis(F.max("modificationTime")).alias("changed_ms"))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The last entry of every hour of the ledger; no rows without one."""
    if not tables.exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    entry = F.max_by(F.struct(*STATE), F.struct("loaded_at", "changed_ms")).alias("state")
    return (spark.read.schema(LEDGER).parquet(path).groupBy("dt", "hour")
            .agg(entry, F.max("loaded_at").alias("loaded_at")).select("dt", "hour", "state.*", "loaded_at"))


def record(spark: SparkSession, hours: DataFrame, path: str) -> None:
    """Append ``hours`` (dt, hour and the state they were loaded in)."""
    (hours.select("dt", "hour", *STATE, F.current_timestamp().alias("loaded_at")).coalesce(1)
     .write.mode("append").parquet(path))


def plan(spark: SparkSession, root: str, path: str, first: _dt.datetime, last: _dt.datetime) -> DataFrame:
    """Every expected hour with its ``status`` and the state of its files."""
    landed = landed_hours(spark, root, first.date(), last.date())
    loaded = read(spark, path).select("dt", "hour", F.struct(*STATE).alias("then"))
    now = F.struct(*STATE)
    status = (F.when(F.col("n_files").isNull(), F.lit("missing")).when(F.col("then").isNull(), F.lit("pending"))
              .when(F.col("then") != now, F.lit("relanded")).otherwise(F.lit("done")))
    return (expected_hours(spark, first, last).join(landed, ["dt", "hour"], "left").join(loaded, ["dt", "hour"], "left")
            .select("dt", "hour", status.alias("status"), *STATE))


def read_hours(spark: SparkSession, root: str, hours: list[tuple[_dt.date, str]], fmt: str = "json") -> DataFrame:
    """Landed envelopes of these hours: only their folders are opened."""
    paths = [f"{root.rstrip('/')}/dt={dt.isoformat()}/hour={hour}" for dt, hour in hours]
    if not paths:
        return spark.createDataFrame([], schemas.RAW_TABLE)
    return spark.read.schema(schemas.RAW_TABLE).format(fmt).option("basePath", root).load(paths)


def catch_up(spark: SparkSession, root: str, path: str, first: _dt.datetime, last: _dt.datetime,
             load: Callable[[DataFrame], object], max_hours: int = 24 * 7, fmt: str = "json") -> int:
    """Load what the plan says, oldest first, at most ``max_hours`` at a time
    (a load caches what it parses), and record each such batch when it is
    loaded.  A run that dies goes on with the hours it did not record.  Returns
    how many hours were loaded.  What reaches the driver is one row per hour of
    the range."""
    todo = plan(spark, root, path, first, last).where(F.col("status").isin(*TO_LOAD)).orderBy("dt", "hour").collect()
    for at in range(0, len(todo), max_hours):
        part = todo[at:at + max_hours]
        load(read_hours(spark, root, [(r.dt, r.hour) for r in part], fmt))
        state = spark.createDataFrame([(r.dt, r.hour, *[r[c] for c in STATE]) for r in part],
                                      "dt DATE, hour STRING, n_files BIGINT, n_bytes BIGINT, changed_ms BIGINT")
        record(spark, state, path)
    return len(todo)
