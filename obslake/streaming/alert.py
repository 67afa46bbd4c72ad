"""The failure alert on a stream of finished-task events.

Same aggregation as the batch form (:mod:`obslake.operators.alert`), over
sliding windows.  The watermark follows the failures' own time, so one that
is late by up to ``delay`` counts, and state older than that is dropped.  Windows are given out in update mode: an alert
is raised in the micro-batch of its failure, not when the watermark has
passed, and a window that changes is given out again.  The table keeps the
rows of each micro-batch apart; :func:`read_alerts` takes the latest of each
window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions import time as tf
from obslake.operators import alert
from obslake.operators.dedupe import dedupe

ALERT_DDL = "window_start TIMESTAMP_NTZ, window_end TIMESTAMP_NTZ, n_failed BIGINT, firing BOOLEAN"


def failure_alert_stream(events: DataFrame, ts: str, failed: Column,
                         delay: str = "10 minutes") -> DataFrame:
    """Raised windows with their failure count and firing flag; for update
    mode (append mode holds a window back until the watermark passed it)."""
    span = alert.WINDOW_MINUTES + alert.HOLD_MINUTES
    t = F.col("_t")
    w = (events.where(failed & F.col(ts).isNotNull())
         .withColumn("_t", tf.utc_to_instant(F.col(ts))).withWatermark("_t", delay)
         .select(F.window(t, f"{span} minutes", "1 minute").alias("w"), t)
         .withColumn("o", F.floor((F.unix_seconds("_t") - F.unix_seconds("w.start")) / 60)))
    out = alert.alert_from_windows(w, start=lambda w: tf.instant_to_utc(w["start"]))
    return out


def run_available(events: DataFrame, ts: str, failed: Column, target: str, checkpoint: str,
                  delay: str = "10 minutes") -> None:
    """Alert over every event available now, then stop.  A micro-batch that
    is repeated replaces its own rows."""
    def per_batch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={epoch}")

    q = (failure_alert_stream(events, ts, failed, delay).writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint)
         .outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination()


def read_alerts(spark: SparkSession, target: str) -> DataFrame:
    """Every raised window as the last micro-batch that touched it left it."""
    rows = spark.read.schema(f"{ALERT_DDL}, batch BIGINT").parquet(target)
    return dedupe(rows, ["window_start"], -F.col("batch")).drop("batch")
