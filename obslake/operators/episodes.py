"""Alert episodes: firing windows that touch, as one row from start to end.

A window ``[start, start + 5 min)`` that fires belongs to the same episode as
the one before it when they overlap or meet; ``session_window`` merges them.
Windows start on a minute grid and are aggregated before this, so there is at
most one row a minute and series to merge, however many failures there are.
The stream form is :mod:`obslake.streaming.episodes`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions import time as tf
from obslake.operators.alert import WINDOW_MINUTES

COLUMNS = ["episode_start", "episode_end", "n_windows", "most_failed"]


def episodes(windows: DataFrame, series: tuple[str, ...] = ()) -> DataFrame:
    """``episode_start, episode_end, n_windows, most_failed`` (and the columns
    of ``series``) of the firing rows of ``windows`` (``window_start,
    window_end, n_failed, firing``)."""
    # a session ends where no window starts within its last one: one
    # microsecond over the window length, so windows that meet are merged
    gap = f"{WINDOW_MINUTES * 60_000_000 + 1} microseconds"
    firing = windows.where("firing").withColumn("_t", tf.utc_to_instant(F.col("window_start")))
    return (firing.groupBy(*series, F.session_window("_t", gap)).agg(
        F.min("window_start").alias("episode_start"), F.max("window_end").alias("episode_end"),
        F.count(F.lit(1)).alias("n_windows"), F.max("n_failed").alias("most_failed"))
        .select(*series, *COLUMNS))
