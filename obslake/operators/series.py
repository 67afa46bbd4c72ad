"""Ordered readings of many series: extreme variations, increase of counters.

Both look back over a span of time.  A window per series would put a hot one
into one task, so windows are per series and time chunk: a row is in its own
chunk and, as part of a halo, in the next one too where that one looks back at
it.  Only the rows of the last span of a chunk are doubled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from obslake.functions import time as tf
from obslake.operators import asof

HOUR, MINUTE = 3_600_000_000, 60_000_000  # microseconds


def with_halo(rows: DataFrame, time: str, span: int, chunk: int) -> DataFrame:
    """``rows`` by chunk: ``_at`` (microseconds), ``_chunk`` and ``_own``
    (false in the halo, which looks back ``span`` microseconds)."""
    if span > chunk:
        raise ValueError("a chunk is as long as what it looks back at, or longer")
    at = tf.utc_epoch_micros(F.col(time))
    own = F.floor(F.col("_at") / chunk)
    near_end = F.col("_at") >= (own + 1) * chunk - span
    chunks = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    return rows.withColumn("_at", at).withColumn("_chunk", F.explode(chunks)).withColumn("_own", F.col("_chunk") == own)


def _back(by: Sequence[str], first: int, last: int) -> WindowSpec:
    return Window.partitionBy(*by, "_chunk").orderBy("_at").rangeBetween(first, last)


def _lower_median(values: Column) -> Column:
    return F.get(F.array_sort(values), F.floor((F.size(values) - 1) / 2).cast("int"))


# Fixed value: makes the median deviation comparable to a standard deviation.
NORMAL = 1.4826


def variations(readings: DataFrame, by: Sequence[str], time: str, value: str, hours: int = 24, at_least: int = 5,
               limit: float = 3.5, chunk_hours: int = 24 * 7) -> DataFrame:
    """``readings`` with ``n_before`` (readings of the series in the ``hours``
    before), ``delta`` to the last of them, ``score`` and ``extreme``.

    The score is the distance from the median of those readings in units of
    their median deviation (lower medians, so both are readings); none with
    fewer than ``at_least`` readings or without deviation.  Extreme is a score
    beyond ``limit`` either way.  Readings at one time do not see each other;
    of several at the last time before, the largest is taken.  Rows with a
    null time or value are left out."""
    known = readings.where(F.col(time).isNotNull() & F.col(value).isNotNull())
    split = with_halo(known, time, hours * HOUR, chunk_hours * HOUR)
    before = F.collect_list(F.struct("_at", F.col(value).cast("double").alias("v"))).over(_back(by, -hours * HOUR, -1))
    rows = split.withColumn("_before", before).where("_own").withColumn("_vs", F.transform("_before", lambda b: b["v"]))
    rows = rows.withColumn("_median", _lower_median(F.col("_vs")))
    spread = F.transform("_vs", lambda v: F.abs(v - F.col("_median")))
    rows = rows.withColumn("_spread", _lower_median(spread))
    score = F.when((F.size("_vs") >= at_least) & (F.col("_spread") > 0),
                   (F.col(value) - F.col("_median")) / (F.lit(NORMAL) * F.col("_spread")))
    return rows.select(
        *readings.columns, F.size("_vs").cast("bigint").alias("n_before"), (F.col(value) - F.array_max("_before")["v"]).alias("delta"),
        score.alias("score"), F.coalesce(F.abs(score) > limit, F.lit(False)).alias("extreme"))


def counter_increase(samples: DataFrame, by: Sequence[str], time: str, value: str, minutes: int = 5,
                     chunk_hours: int = 24) -> DataFrame:
    """For each sample of a cumulative counter (one per series and time; the
    largest, if there are several) ``step`` from the sample before it, and
    ``increase``, the steps of the last ``minutes`` (the sample's own included,
    one exactly that long ago not).

    A counter that is smaller than before was restarted from zero, so its step
    is all it shows; the first sample of a series has step 0.  The sample
    before may be any time ago: it comes from the as-of lookup, which carries
    one row into a chunk."""
    one = samples.where(F.col(time).isNotNull() & F.col(value).isNotNull()).groupBy(*by, time).agg(
        F.max(value).alias(value))
    prior = one.select(*by, F.col(time).alias("_prior_time"), F.col(value).alias("_prior"))
    paired = asof.as_of(one, prior, by, time, "_prior_time", ["_prior"], chunk_hours, before=True)
    step = (F.when(F.col("_prior").isNull(), F.lit(0)).when(F.col(value) >= F.col("_prior"), F.col(value) - F.col("_prior"))
            .otherwise(F.col(value)))
    stepped = paired.select(*by, time, value, step.alias("step"))
    split = with_halo(stepped, time, minutes * MINUTE, chunk_hours * HOUR)
    increase = F.sum("step").over(_back(by, -(minutes * MINUTE - 1), 0))
    return split.withColumn("increase", increase).where("_own").select(*by, time, value, "step", "increase")
