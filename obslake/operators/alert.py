"""Task-failure alert over a table of finished-task events.

Contract: a window ``[s, s + 5 min)`` (starts on a 1-minute grid) is
*raised* when it holds at least one failure; it *fires* when the window that
starts one minute earlier is raised too ("held for 1 minute").

Both facts come from ONE windowed aggregation: every failure is assigned to
the six 6-minute windows ``[w, w + 6 min)`` that contain it, with its minute
offset ``o`` inside the window.  For ``s = w + 1 min``: the failures of
``[s, s+5)`` are offsets 1..5 and those of ``[s-1, s+4)`` are offsets 0..4.
No self-join, one shuffle on the window start, partial aggregation first
(a minute holding a third of all failures is pre-counted map-side).  The
stream counts the same windows under a watermark on the event time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.functions import time as tf

WINDOW_MINUTES = 5
HOLD_MINUTES = 1


def failure_windows(events: DataFrame, ts: str, failed: Column) -> DataFrame:
    """(w, o) per failure: window start ``w`` and minute offset ``o``."""
    span = WINDOW_MINUTES + HOLD_MINUTES
    return (
        events.where(failed & F.col(ts).isNotNull())
        .select(tf.floor_to(F.col(ts), "minute").alias("_m"),
                F.explode(F.array(*[F.lit(i) for i in range(span)])).alias("o"))
        .select(F.timestamp_add("MINUTE", -F.col("o"), F.col("_m")).alias("w"), "o")
    )


def alert_from_windows(windows: DataFrame, start: Callable[[Column], Column] = lambda w: w) -> DataFrame:
    """Counts per window ``w``; ``start`` gives its start as a wall clock."""
    o = F.col("o")
    counted = windows.groupBy("w").agg(
        F.count_if(o == 0).alias("n_first"),
        F.count_if((o >= 1) & (o <= WINDOW_MINUTES - 1)).alias("n_mid"),
        F.count_if(o == WINDOW_MINUTES).alias("n_last"),
    )
    n_failed = F.col("n_mid") + F.col("n_last")
    return (
        counted.select(
            F.timestamp_add("MINUTE", F.lit(HOLD_MINUTES), start(F.col("w"))).alias("window_start"),
            F.timestamp_add("MINUTE", F.lit(HOLD_MINUTES + WINDOW_MINUTES), start(F.col("w"))).alias("window_end"),
            n_failed.alias("n_failed"),
            ((n_failed > 0) & (F.col("n_first") + F.col("n_mid") > 0)).alias("firing"),
        )
        .where(F.col("n_failed") > 0)
    )


def failure_alert(events: DataFrame, ts: str = "ts", failed: Column | None = None) -> DataFrame:
    """Raised windows with their failure count and firing flag."""
    if failed is None:
        failed = F.col("status") == F.lit("failed")
    return alert_from_windows(failure_windows(events, ts, failed))
