"""Alert episodes of a stream of finished-task events.

The windows come from the streaming alert in update mode, so a window that
changes is given out again.  Episodes that later events can still change are
kept as their firing windows; each micro-batch merges those it gives out into
them and closes the episodes that the watermark has passed.  Version n of the
state (``open`` windows, episodes ``closed`` by that micro-batch) is read by
micro-batch n + 1 only, so one that is repeated writes what it wrote before,
and the state stays as small as the watermark delay.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.operators import alert, episodes
from obslake.operators.dedupe import dedupe
from obslake.sources import tables
from obslake.streaming import alert as stream_alert

EPISODE_DDL = "episode_start TIMESTAMP_NTZ, episode_end TIMESTAMP_NTZ, n_windows BIGINT, most_failed BIGINT"


def _open(spark: SparkSession, root: str, version: int) -> DataFrame:
    path = f"{root}/open/v{version}"
    if not tables.exists(spark, path):
        return spark.createDataFrame([], stream_alert.ALERT_DDL)
    return spark.read.schema(stream_alert.ALERT_DDL).parquet(path)


def merge_batch(windows: DataFrame, root: str, version: int, delay_minutes: int) -> None:
    """One micro-batch of raised windows into the state: reads version
    ``version``, writes ``version + 1``."""
    spark = windows.sparkSession
    both = (windows.where("firing").withColumn("_age", F.lit(0))
            .unionByName(_open(spark, root, version).withColumn("_age", F.lit(1))))
    kept = dedupe(both, ["window_start"], "_age").persist()
    try:
        last = kept.agg(F.max("window_start")).first()[0]
        found = episodes.episodes(kept)
        if last is None:
            done = F.lit(False)
        else:
            # an event that is late by the whole delay still reaches the
            # windows that hold it
            span = delay_minutes + alert.WINDOW_MINUTES + alert.HOLD_MINUTES
            done = F.col("episode_end") < F.lit((last - _dt.timedelta(minutes=span)).isoformat(sep=" ")).cast("timestamp_ntz")
        found.where(done).coalesce(1).write.mode("overwrite").parquet(f"{root}/closed/v{version + 1}")
        bound = found.where(~done).agg(F.min("episode_start")).first()[0]
        left = kept.where(F.lit(False)) if bound is None else kept.where(
            F.col("window_start") >= F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz"))
        left.coalesce(1).write.mode("overwrite").parquet(f"{root}/open/v{version + 1}")
    finally:
        kept.unpersist()


def run_available(events: DataFrame, ts: str, failed: Column, root: str, checkpoint: str,
                  delay_minutes: int = 10) -> int:
    """Episodes over every event available now; returns the state's version
    (read it with :func:`read`)."""
    done = [0]

    def per_batch(batch: DataFrame, epoch: int) -> None:
        merge_batch(batch, root, epoch, delay_minutes)
        done[0] = epoch + 1

    q = (stream_alert.failure_alert_stream(events, ts, failed, f"{delay_minutes} minutes").writeStream
         .foreachBatch(per_batch).option("checkpointLocation", checkpoint)
         .outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination()
    return done[0]


def read(spark: SparkSession, root: str, version: int) -> DataFrame:
    """All episodes up to a version: the closed ones and those still open."""
    closed = [f"{root}/closed/v{i}" for i in range(1, version + 1)]
    still = episodes.episodes(_open(spark, root, version))
    return spark.read.schema(EPISODE_DDL).parquet(*closed).unionByName(still) if closed else still
