"""Incremental load: insert only rows whose business key is not stored yet.

One existence join marks every row of the batch (``EXISTS`` over the stored
keys as a column): stored keys are not made distinct first, and the batch,
usually the output of the dedupe and hash-partitioned on the same key already,
is not shuffled again; only the stored keys are.  Only key columns of the
target are read (column pruning reaches the scan), and when the key contains
the fetch time the read is bounded by the batch's smallest fetch time, given
as a literal so it is pushed into the scan (and prunes ``fetched_date``
partitions of a file target).
"""

from __future__ import annotations

from collections.abc import Sequence
import datetime as _dt
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.operators import keytable
from obslake.sources import tables


def stored_keys(stored: DataFrame, keys: Sequence[str], bound_col: str | None = None,
                bound: _dt.datetime | None = None) -> DataFrame:
    k = stored
    if bound_col is not None and bound is not None:
        k = k.where(F.col(bound_col) >= F.lit(bound).cast("timestamp_ntz"))
        if "fetched_date" in stored.columns:
            k = k.where(F.col("fetched_date") >= F.lit(bound.date()))
    cond = None
    for c in keys:
        nn = F.col(c).isNotNull()
        cond = nn if cond is None else cond & nn
    return k.select(*keys).where(cond)


def mark_stored(batch: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``batch`` with ``_stored``: whether its key is among ``known``.  A key
    with a null equals nothing and counts as not stored."""
    same = reduce(and_, [F.col(f"_known.{k}") == F.col(f"_batch.{k}").outer() for k in keys])
    return batch.alias("_batch").withColumn("_stored", known.alias("_known").where(same).exists())


def unseen(batch: DataFrame, stored: DataFrame, keys: Sequence[str],
           bound_col: str | None = None, bound: _dt.datetime | None = None) -> DataFrame:
    """Rows of ``batch`` whose key is absent from ``stored``.

    A null key never equals anything, so such a row would always look new;
    null keys are rejected by the fact builders before this point.
    """
    marked = mark_stored(batch, stored_keys(stored, keys, bound_col, bound), keys)
    return marked.where(~F.col("_stored")).drop("_stored")


def fetch_range(batch: DataFrame, col: str) -> tuple[_dt.datetime | None, _dt.datetime | None]:
    """Smallest and largest ``col`` of a (persisted) batch: two scalars."""
    lo, hi = batch.agg(F.min(col), F.max(col)).first()
    return lo, hi


DAY_FOLDER = "fetched_date="


def read_days(spark: SparkSession, target: str, schema, first: _dt.date,
              last: _dt.date) -> DataFrame:
    """The ``fetched_date`` folders of ``target`` from ``first`` to ``last``.

    One listing of the target names its day folders; only those of the range
    are opened (a path read would list the files of every day ever appended
    before it prunes).
    """
    lo, hi = first.isoformat(), last.isoformat()
    present = [f"{target}/{name}" for name, _, _ in tables.children(spark, target)
               if name.startswith(DAY_FOLDER) and lo <= name.removeprefix(DAY_FOLDER) <= hi]
    if not present:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", target).parquet(*present)


def with_fetched_date(df: DataFrame) -> DataFrame:
    return df.withColumn("fetched_date", F.to_date("fetched_at"))


def write_facts(df: DataFrame, target: str) -> None:
    """Append fact rows to ``target``, partitioned by ``fetched_date``.

    A rebalance on the date first: rows of one day meet in the same tasks,
    so a day is written as a few files of about the advisory size instead of
    one small file per shuffle partition, and AQE splits a day that holds a
    large share of the rows over several tasks.
    """
    (with_fetched_date(df).hint("rebalance", "fetched_date")
     .write.mode("append").partitionBy("fetched_date").parquet(target))


def append_unseen(spark: SparkSession, batch: DataFrame, target: str, keys: Sequence[str],
                  bounds: tuple[_dt.datetime, _dt.datetime] | None = None,
                  key_buckets: int | None = None) -> dict[str, int]:
    """Append the rows of ``batch`` whose key the file target does not have
    and return the rows ``calculated`` (in the batch) and ``inserted``.

    The target is Parquet partitioned by ``fetched_date``.  Where the fetch
    time is one of the ``keys``, a stored row can only match a batch row of
    its day, so only the days of the batch's fetch range are read (``bounds``
    where the caller knows a range that holds the batch, else one aggregate
    over the batch, which is cached for that); for other keys all stored keys
    are, and with ``key_buckets`` they are kept as a bucketed table beside the
    target, which is joined without an exchange (see
    :mod:`obslake.operators.keytable`).  One action marks and counts the batch; with ``bounds`` it also fills
    the cache that the write reads, so there is one cache either way.
    """
    with tables.compiled(batch.sparkSession):
        return _append_unseen(spark, batch, target, keys, bounds, key_buckets)


def _append_unseen(spark: SparkSession, batch: DataFrame, target: str, keys: Sequence[str],
                   bounds: tuple[_dt.datetime, _dt.datetime] | None, key_buckets: int | None) -> dict[str, int]:
    exists = tables.exists(spark, target)
    bucketed = key_buckets is not None and "fetched_at" not in keys
    ranged = exists and "fetched_at" in keys and bounds is None
    cached = batch = batch.persist() if ranged else batch
    if not exists:
        marked = batch.withColumn("_stored", F.lit(False))
    else:
        # explicit schema: a run that appended nothing leaves no data file
        schema = with_fetched_date(batch).schema
        if "fetched_at" in keys:
            lo, hi = bounds or fetch_range(batch, "fetched_at")
            stored = (read_days(spark, target, schema, lo.date(), hi.date()) if lo is not None
                      else spark.createDataFrame([], schema))
            known = stored_keys(stored, keys, "fetched_at", lo)
        elif bucketed:
            name, buckets = keytable.opened(spark, target, spark.read.schema(schema).parquet(target), keys, key_buckets)
            known, batch = spark.table(name), batch.repartition(buckets, *keys)
        else:
            known = stored_keys(spark.read.schema(schema).parquet(target), keys)
        marked = mark_stored(batch, known, keys)
    if not ranged:
        cached = marked = marked.persist()
    try:
        n, new = marked.agg(F.count(F.lit(1)), F.count_if(~F.col("_stored"))).first()
        # Guarded write: an empty partitioned append would leave a stray
        # unpartitioned file in the target.
        if new:
            fresh = marked.where(~F.col("_stored")).drop("_stored")
            if exists and bucketed:
                keytable.begin(spark, target)
            write_facts(fresh, target)
            if exists and bucketed:
                keytable.add(spark, target, name, fresh, keys, buckets)
        return {"calculated": n, "inserted": new}
    finally:
        cached.unpersist()


def compact_day(spark: SparkSession, target: str, day: _dt.date) -> int:
    """Rewrite one ``fetched_date`` partition of a fact target in files of
    about the advisory size; returns its row count.

    The day is checkpointed first (reliable, in the shared folder): that
    materializes it once and cuts the plan's link to the target path, so
    the dynamic overwrite of that single partition never reads what it is
    replacing.  Other days are untouched.  If the day's files changed since
    the read (a load appended to it), nothing is replaced and the call fails:
    compact days that no load writes to any more, or try again.
    """
    tables.shared_dir(spark)
    folder = f"{target}/{DAY_FOLDER}{day.isoformat()}"
    before = tables.children(spark, folder)
    part = spark.read.parquet(target).where(F.col("fetched_date") == F.lit(day))
    data = part.hint("rebalance").checkpoint(eager=True)
    n = data.count()
    if n:
        if tables.children(spark, folder) != before:
            raise RuntimeError(f"{folder} changed while it was compacted")
        (data.hint("rebalance").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("fetched_date").parquet(target))
    return n
