"""Current-conditions facts and the long-form forecast fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions.paths import at
from obslake.operators.dedupe import dedupe
from obslake.operators.lookup import attach_place
from obslake.specs import PAYLOAD, FactSpec, ForecastSpec


def current_fact(parsed: DataFrame, dimension: DataFrame, spec: FactSpec) -> DataFrame:
    """Parsed feed -> one row per (place_id, fetched_at).

    Field map applied, place looked up, then one shuffle on the fact key for
    the deterministic dedupe.  Rows without an event or
    fetch time are rejected before the key is formed.
    """
    p = F.col(PAYLOAD)
    measures = (
        parsed
        .where(F.col("measured_at").isNotNull() & F.col("fetched_at").isNotNull())
        .select(
            "place_key", "country", "measured_at", "fetched_at", "rank",
            *[at(p, path).alias(name) for name, path in spec.fields.items()],
        )
    )
    joined = attach_place(measures, dimension)
    return dedupe(joined, spec.keys, "rank").select(*spec.columns)


def forecast_days(parsed: DataFrame, spec: ForecastSpec) -> DataFrame:
    """Wide daily arrays -> one row per (pollutant, day), before lookup.

    One generator over the concatenation of all pollutant arrays (tagged
    with their pollutant), instead of one scan + explode per pollutant and a
    union: the payload is read once.  A missing or empty array contributes
    no row; a day that does not parse is dropped.  The position in the arrays
    is part of the rank: of a day listed twice the first one wins.
    """
    daily = at(F.col(PAYLOAD), spec.daily_path)
    def tag(name: str):
        # one-argument lambda: F.transform passes the index to a second one
        return lambda d: F.struct(F.lit(name).alias("pollutant"), d.alias("d"))

    tagged = [F.transform(F.coalesce(daily.getField(name), F.array()), tag(name))
              for name in spec.pollutants]
    return (
        parsed
        .where(daily.isNotNull() & F.col("fetched_at").isNotNull())
        .select("place_key", "country", "fetched_at", "rank",
                F.posexplode(F.flatten(F.array(*tagged))).alias("pos", "f"))
        .select(
            "place_key", "country", "fetched_at", F.struct("rank", "pos").alias("rank"),
            F.col("f.pollutant").alias("pollutant"),
            F.col("f.d.day").try_cast("date").alias("forecast_date"),
            F.col("f.d.min").cast("double").alias("value_min"),
            F.col("f.d.avg").cast("double").alias("value_avg"),
            F.col("f.d.max").cast("double").alias("value_max"),
        )
        .where(F.col("forecast_date").isNotNull())
    )


def forecast_fact(parsed: DataFrame, dimension: DataFrame, spec: ForecastSpec) -> DataFrame:
    joined = attach_place(forecast_days(parsed, spec), dimension)
    return dedupe(joined, spec.keys, "rank").select(*spec.columns)
