"""Joining measures to the place dimension.

The join is left to the optimizer: the dimension is broadcast where Spark's
own size estimate (or the bytes that adaptive execution measured) is under
its threshold, else it is a shuffle join, of which hot keys are split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions import names


def lookup_table(dimension: DataFrame) -> DataFrame:
    """Dimension reduced to (place_key, country) -> place_id.  Names that
    share a lookup key (``Straße`` / ``Strasse``) share the smallest id, so a
    measure never joins twice.  That answer changes when a name with a smaller
    id comes in: jobs that run again use the stored one
    (:mod:`obslake.operators.registry`)."""
    return (dimension.select("place_id", names.lookup_key(F.col("name")).alias("place_key"), "country")
            .where(F.col("place_key").isNotNull())
            .groupBy("place_key", "country").agg(F.min("place_id").alias("place_id")))


def attach_place(rows: DataFrame, places: DataFrame) -> DataFrame:
    """Inner join on (lookup key, country) with a dimension, or with a lookup
    (``place_key, country, place_id``) that was made before.

    Country is part of the key so equal names in two countries do not fan
    out.  Rows whose place is unknown are dropped (count them with
    :func:`obslake.operators.metrics.feed_metrics`).
    """
    known = places if "place_key" in places.columns else lookup_table(places)
    return rows.join(known, ["place_key", "country"], "inner").drop("place_key", "country")
