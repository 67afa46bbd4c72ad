"""Incremental raw -> silver as a Structured Streaming job.

The file source tracks which landed files were processed (checkpoint), and
each micro-batch runs the batch operators and the anti-join append, so a
retried batch appends nothing twice (exact form).  ``watermark_dedupe`` is
the cheap form: state bounded by the watermark, keys older than the delay
are forgotten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake import schemas
from obslake.functions import time as tf
from obslake.operators import facts, incremental, parse
from obslake.plans import silver
from obslake.sources import tables
from obslake.specs import FactSpec


def raw_stream(spark: SparkSession, raw_root: str, fmt: str = "json", max_files: int | None = None,
               max_bytes: str | None = None) -> DataFrame:
    """Landed envelopes as a stream.  ``max_files`` or ``max_bytes`` (such as
    ``10g``) bound a micro-batch, so a backlog is worked off in several; a
    micro-batch is what the load caches."""
    reader = spark.readStream.schema(schemas.RAW_TABLE).format(fmt)
    if max_files is not None and max_bytes is not None:
        raise ValueError("a micro-batch is bounded by files or by bytes")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader.load(raw_root)


def _run(stream: DataFrame, per_batch, checkpoint: str) -> None:
    # the stream's session is a copy of this one from its start
    with tables.compiled(stream.sparkSession):
        q = (stream.writeStream.foreachBatch(per_batch)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        q.awaitTermination()


def dimension_version(root: str, epoch: int) -> str:
    """The dimension that micro-batch ``epoch`` reads; it writes the next."""
    return f"{root}/v{epoch}"


def run_silver(spark: SparkSession, raw_root: str, dimension_root: str, facts_root: str,
               checkpoint: str, fmt: str = "json", fill_null: bool = False, max_files: int | None = None,
               max_bytes: str | None = None, metrics_root: str | None = None) -> int:
    """The whole silver step over every landed file not seen by ``checkpoint``
    yet: each micro-batch upserts the dimension, then loads all facts, so a
    place that is new in a batch has its rows stored with it.

    ``dimension_root`` holds one folder per version, ``v0`` from the caller;
    micro-batch n reads ``vn`` and writes ``vn+1``, so one that is repeated
    reads what it read before.  Returns how many micro-batches this run had.
    A backlog is worked off in micro-batches of ``max_files`` or ``max_bytes``.
    With ``metrics_root`` the counts of each micro-batch are stored
    (:func:`read_metrics`); one that is repeated replaces its own.
    """
    done = []

    def per_batch(batch: DataFrame, epoch: int) -> None:
        found = silver.load(spark, batch, dimension_version(dimension_root, epoch),
                            dimension_version(dimension_root, epoch + 1), facts_root, fill_null)
        if metrics_root is not None:
            (spark.createDataFrame(sorted(found.items()), METRICS).coalesce(1)
             .write.mode("overwrite").parquet(f"{metrics_root}/batch={epoch}"))
        done.append(epoch)

    _run(raw_stream(spark, raw_root, fmt, max_files, max_bytes), per_batch, checkpoint)
    return len(done)


METRICS = "metric STRING, value BIGINT"


def read_metrics(spark: SparkSession, metrics_root: str) -> DataFrame:
    """``batch, metric, value`` of every micro-batch of a running stream."""
    return spark.read.schema(f"{METRICS}, batch BIGINT").parquet(metrics_root)


def run_available(spark: SparkSession, raw_root: str, dimension: DataFrame, spec: FactSpec,
                  target: str, checkpoint: str, fmt: str = "json", max_files: int | None = None,
                  max_bytes: str | None = None) -> int:
    """One fact alone, against a dimension that is complete already: rows of
    places it does not know are passed over for good.  Where places can be
    new, use :func:`run_silver`.  Returns how many micro-batches there were."""
    done = []

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        # parse once: composed lazily, the validity filter would evaluate a
        # second from_json of every payload
        parsed = parse.parse_payload(parse.route_feed(batch, spec.feed), spec.feed, persisted=True).persist()
        try:
            fact = facts.current_fact(parse.validate(parsed, spec.feed), dimension, spec)
            lo, hi = incremental.fetch_range(parsed, "fetched_at")
            incremental.append_unseen(spark, fact, target, spec.keys, (lo, hi) if lo is not None else None)
            done.append(epoch_id)
        finally:
            parsed.unpersist()

    _run(raw_stream(spark, raw_root, fmt, max_files, max_bytes), per_batch, checkpoint)
    return len(done)


def watermark_dedupe(parsed_stream: DataFrame, keys: list[str], delay: str = "2 hours") -> DataFrame:
    """Drop repeated keys within the watermark delay (bounded state)."""
    return (parsed_stream
            .withColumn("_event_ts", tf.utc_to_instant(F.col("fetched_at")))
            .withWatermark("_event_ts", delay)
            .dropDuplicatesWithinWatermark(keys)
            .drop("_event_ts"))
