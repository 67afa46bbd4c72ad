"""As-of lookup: for every left row the last right row at or before its time.

Both sides are united and sorted once; a window carries the last right row
forward.  The window is not one per key, which would put a hot place into one
task, but one per key and time chunk.  What a chunk needs from before its start
is one row: the last right row of any earlier chunk.  These come from an
aggregate with one row per key and chunk, carried over the chunks of a key, and
are united with the rest as a row at the start of the chunk.  No row is joined
with the rows of its key, and no range join is done.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from obslake.functions import time as tf

CHUNK_HOURS = 24


def as_of(left: DataFrame, right: DataFrame, by: Sequence[str], left_time: str, right_time: str,
          values: Sequence[str], chunk_hours: int = CHUNK_HOURS, before: bool = False) -> DataFrame:
    """``left`` with ``right_time`` and ``values`` of the last row of ``right``
    that has its ``by`` columns and a time not after its own (with ``before``:
    one before its own); nulls where there is none.

    Rows of ``left`` are all kept.  A null in ``by`` or in the time finds
    nothing; such rows of ``right`` are found by nothing.  Of right rows with
    one key and time the one with the largest values is taken.  Times are
    wall clocks (``timestamp_ntz``).  ``values`` and ``right_time`` must not
    be columns of ``left``.
    """
    found = [right_time, *values]
    if clash := set(found) & set(left.columns):
        raise ValueError(f"columns of both sides: {sorted(clash)}")
    keys = [f"_k{i}" for i in range(len(by))]

    def keyed(df: DataFrame, time: str):
        return [F.col(c).alias(k) for c, k in zip(by, keys)] + [
            F.floor(tf.utc_epoch_seconds(F.col(time)) / (3600 * chunk_hours)).alias("_chunk"), F.col(time).alias("_t")]

    usable = F.lit(True)
    for k in (*keys, "_t"):
        usable = usable & F.col(k).isNotNull()
    picked = F.struct(*[F.col(c) for c in found]).alias("_found")
    r = right.select(*keyed(right, right_time), picked).where(usable)
    whole = left.select(*keyed(left, left_time), F.struct(*[F.col(c) for c in left.columns]).alias("_row"))
    lost = whole.where(~usable)
    l = whole.where(usable)

    # the last right row of each chunk, carried into the chunks after it
    chunk = [*keys, "_chunk"]
    nothing = F.lit(None).cast(r.schema["_found"].dataType).alias("_found")
    lasts = r.select(*chunk, "_found").unionByName(l.select(*chunk, nothing).distinct())
    per_chunk = lasts.groupBy(*chunk).agg(F.max("_found").alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = per_chunk.select(*chunk, F.last("_last", ignorenulls=True).over(earlier).alias("_found")).where(
        F.col("_found").isNotNull())

    no_row = F.lit(None).cast(l.schema["_row"].dataType).alias("_row")
    no_time = F.lit(None).cast("timestamp_ntz").alias("_t")  # sorts before the chunk's own
    everything = (l.select(*chunk, "_t", "_row", nothing)
                  .unionByName(r.select(*chunk, "_t", no_row, "_found"))
                  .unionByName(carried.select(*chunk, no_time, no_row, "_found")))
    # at one time the rows of the right come first, with ``before`` those of the left
    asks = F.col("_row").isNull() if before else F.col("_row").isNotNull()
    upto = Window.partitionBy(*chunk).orderBy("_t", asks, "_found").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    seen = everything.withColumn("_found", F.last("_found", ignorenulls=True).over(upto)).where(F.col("_row").isNotNull())
    return (seen.select("_row.*", *[F.col(f"_found.{c}").alias(c) for c in found])
            .unionByName(lost.select("_row.*", *[F.lit(None).cast(right.schema[c].dataType).alias(c) for c in found])))


def forecast_in_force(readings: DataFrame, forecasts: DataFrame, pollutants: Sequence[str],
                      chunk_hours: int = CHUNK_HOURS) -> DataFrame:
    """The forecast that was in force for a reading: for each reading
    (``place_id, measured_at``) and pollutant, the last forecast for its day
    that had been fetched by then."""
    asked = readings.select(
        "place_id", "measured_at", F.to_date("measured_at").alias("forecast_date"),
        F.explode(F.array(*[F.lit(p) for p in pollutants])).alias("pollutant"))
    known = forecasts.select("place_id", "pollutant", "forecast_date", F.col("fetched_at").alias("forecast_at"),
                             "value_min", "value_avg", "value_max")
    return as_of(asked, known, ["place_id", "pollutant", "forecast_date"], "measured_at", "forecast_at",
                 ["value_min", "value_avg", "value_max"], chunk_hours)
