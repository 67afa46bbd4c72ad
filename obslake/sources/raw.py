"""Raw envelopes: build, land (partitioned JSON), read back (pruned)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake import schemas
from obslake.functions import time as tf
from obslake.functions.urls import redact_secrets
from obslake.sources import tables


def envelope(responses: DataFrame) -> DataFrame:
    """Responses -> envelope rows.

    ``responses``: request_id, feed, place_name, url, http_status, body,
    fetched_at (UTC wall clock) and, where requests had one, country.  Status 0 means the request never got an
    answer and ``body`` holds the error text.

    * ``ok``  = status 200
    * ``error`` = null when ok, the error text for status 0, else
      ``HTTP_<status>``
    * secrets are redacted before anything is landed: in the URL, and in what
      a failed call answered (error texts quote URLs)
    * the fetch stamp is an ISO string with milliseconds and ``Z``, so it
      means the same instant whoever reads it
    """
    status = F.col("http_status").cast("int")
    ok = F.coalesce(status == 200, F.lit(False))
    body = F.when(ok, F.col("body")).otherwise(redact_secrets(F.col("body")))
    country = F.col("country") if "country" in responses.columns else F.lit(None)
    return responses.select(
        F.col("request_id").cast("long").alias("request_id"),
        "feed",
        "place_name",
        redact_secrets(F.col("url")).alias("url"),
        status.alias("http_status"),
        ok.alias("ok"),
        F.when(ok, F.lit(None).cast("string"))
         .when(status == 0, body)
         .otherwise(F.concat(F.lit("HTTP_"), status.cast("string"))).alias("error"),
        tf.format_utc_iso(F.col("fetched_at")).alias("fetched_at_utc"),
        body.alias("payload"),
        country.cast("string").alias("country"),
    )


def with_partition_keys(env: DataFrame, zone: str = "UTC") -> DataFrame:
    """``dt``/``hour`` of the fetch time.  UTC by default (a local hour
    repeats at the autumn clock change); pass a zone for local keys."""
    dt, hour = tf.partition_keys(tf.parse_instant(F.col("fetched_at_utc")), zone)
    return env.withColumns({"dt": dt, "hour": hour})


def land(env: DataFrame, root: str, zone: str = "UTC", fmt: str = "json",
         partition_by: tuple[str, ...] = ("dt", "hour"), cluster: bool = False,
         max_records_per_file: int = 5_000_000, tasks: int | None = None) -> None:
    """Write envelopes partitioned by ``partition_by`` (default dt, hour),
    replacing only the partitions present in ``env`` (dynamic overwrite set
    as a write option, so it does not depend on session conf).  An empty
    frame replaces nothing.

    Default: no shuffle (each task sorts its rows by partition and writes one
    file per partition it holds), so re-landing a fetch never re-runs it and
    a hot hour is spread over the tasks that fetched it.  ``cluster=True``
    (backfills of recomputable input) range-partitions on the partition
    columns plus ``request_id`` first: fewer files, and a hot hour is still
    split across several tasks instead of landing in one.  The number of
    range partitions is sized by AQE from the data unless ``tasks`` is given:
    AQE sizes by bytes, so a small backfill spanning many hours would create
    all its hour folders from one task; ``tasks`` keeps them parallel.
    """
    keyed = with_partition_keys(env, zone)
    if cluster:
        cols = (*partition_by, "request_id")
        keyed = (keyed.repartitionByRange(tasks, *cols) if tasks
                 else keyed.repartitionByRange(*cols))
    else:
        keyed = keyed.sortWithinPartitions(*partition_by)
    with tables.compiled(env.sparkSession):
        (keyed.write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic")
         .option("maxRecordsPerFile", max_records_per_file)
         .partitionBy(*partition_by)
         .format(fmt)
         .save(root))


def _open(spark: SparkSession, root: str, schema: str, fmt: str, dt: str | None,
          hour: str | None) -> DataFrame:
    """Landed rows of ``root``, opening only the partition folder asked for.

    Loading the root lists every hour ever landed before partition pruning;
    an hourly job needs one folder, so it opens ``dt=../hour=..`` (or
    ``dt=..`` when hours are not folders) with the root as ``basePath``.  A
    missing folder gives zero rows.  The filters stay, so the result is the
    same as a pruned read of the root.
    """
    reader = spark.read.schema(schema).format(fmt)
    if dt is None:
        df = reader.load(root)
    else:
        day = f"{root.rstrip('/')}/dt={dt}"
        leaf = f"{day}/hour={hour}" if hour is not None else None
        if leaf is not None and tables.exists(spark, leaf):
            path = leaf
        elif tables.exists(spark, day):
            path = day
        else:
            return spark.createDataFrame([], schema)
        df = reader.option("basePath", root).load(path)
        df = df.where(F.col("dt") == F.lit(dt).cast("date"))
    if hour is not None:
        df = df.where(F.col("hour") == F.lit(hour))
    return df


def read_raw(spark: SparkSession, root: str, dt: str | None = None, hour: str | None = None,
             fmt: str = "json") -> DataFrame:
    """Read landed envelopes with the explicit schema (no inference: an empty
    folder gives zero rows, ``hour`` stays a two-character string).  With
    ``dt`` (and ``hour``) only that partition folder is opened."""
    return _open(spark, root, schemas.RAW_TABLE, fmt, dt, hour)


def from_legacy(df: DataFrame, feeds) -> DataFrame:
    """Older-layout rows -> envelope rows (same columns as :func:`envelope`).

    No request ids exist there, so the dedupe order falls back to the payload
    hash (still deterministic); the feed comes from the URL host.
    """
    feed = F.lit(None).cast("string")
    for f in feeds:
        feed = F.when(F.col("url").contains(f.url_marker), F.lit(f.name)).otherwise(feed)
    status = F.col("http_status").cast("int")
    ok = F.coalesce(F.col("ok"), F.lit(False))
    extra = [c for c in ("dt", "hour") if c in df.columns]
    payload = F.when(ok, F.col("payload")).otherwise(redact_secrets(F.col("payload")))
    return df.select(
        F.lit(None).cast("long").alias("request_id"),
        feed.alias("feed"),
        F.col("city_name").alias("place_name"),
        redact_secrets(F.col("url")).alias("url"),
        status.alias("http_status"),
        ok.alias("ok"),
        F.when(ok, F.lit(None).cast("string"))
         .when(status == 0, payload)
         .otherwise(F.concat(F.lit("HTTP_"), status.cast("string"))).alias("error"),
        "fetched_at_utc",
        payload.alias("payload"),
        F.lit(None).cast("string").alias("country"),
        *extra,
    )


def read_legacy(spark: SparkSession, root: str, feeds, dt: str | None = None,
                hour: str | None = None, fmt: str = "json") -> DataFrame:
    """Read raw landed in the older layout (explicit schema; with ``dt``
    and ``hour`` only that partition folder is opened)."""
    return from_legacy(_open(spark, root, schemas.LEGACY_RAW_TABLE, fmt, dt, hour), feeds)
