"""Place registry: which id a place has, and which place a lookup key means.

Both are decided once and stored beside the facts, in an append-only table
(one row per natural key):

* ``place_id``  the id that facts and dimension know the place by;
* ``place_key`` the lookup form of its name;
* ``canonical_id`` the place that this lookup key stands for.

Several names can share a lookup key (``Strasse`` / ``Straße``).  The first
load that sees the key decides; a spelling that arrives later, in another hour
or in a rerun of the same one, gets the stored decision, however its own id
compares.  So a rerun finds its readings stored under the id it would give
them, and stores nothing twice.

The registry is written after the dimension and before the facts.  A load that
dies in between is repeated with the decisions it left; a partly written
append is completed, as only unknown places are added.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obslake import schemas
from obslake.functions import names
from obslake.sources import tables

NAME = "place_registry"
KEY = list(schemas.DIMENSION_KEY)
COLUMNS = ["place_id", *KEY, "place_key", "canonical_id"]


def read(spark: SparkSession, root: str) -> DataFrame:
    """The registry stored under ``root``; no rows when there is none yet."""
    path = f"{root.rstrip('/')}/{NAME}"
    if not tables.exists(spark, path):
        return spark.createDataFrame([], schemas.REGISTRY)
    return spark.read.schema(schemas.REGISTRY).parquet(path)


def decisions(dimension: DataFrame, registry: DataFrame) -> DataFrame:
    """Rows to add: the places of ``dimension`` that the registry does not
    have.  A lookup key that it knows keeps its place; a new key stands for
    the smallest of its ids.  Places without a lookup key or a country, which
    no lookup can meet, have no row."""
    fresh = (dimension.select("place_id", *KEY, names.lookup_key(F.col("name")).alias("place_key"))
             .where(F.col("place_key").isNotNull() & F.col("country").isNotNull()).join(registry.select(*KEY), KEY, "left_anti"))
    known = lookup(registry).withColumnRenamed("place_id", "known_id")
    first = F.min("place_id").over(Window.partitionBy("place_key", "country"))
    return (fresh.join(known, ["place_key", "country"], "left")
            .withColumn("canonical_id", F.coalesce("known_id", first)).select(*COLUMNS))


def lookup(registry: DataFrame) -> DataFrame:
    """(place_key, country) -> place_id, one row each."""
    return registry.groupBy("place_key", "country").agg(F.min("canonical_id").alias("place_id"))


def update(spark: SparkSession, root: str, dimension: DataFrame) -> DataFrame:
    """Add what ``dimension`` has and the registry does not; the registry
    then."""
    new = decisions(dimension, read(spark, root)).persist()
    try:
        if not new.isEmpty():
            new.hint("rebalance").write.mode("append").parquet(f"{root.rstrip('/')}/{NAME}")
    finally:
        new.unpersist()
    return read(spark, root)
