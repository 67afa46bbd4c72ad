"""Place dimension: candidates from the feeds, insert-only upsert, optional
fill-null of details, surrogate ids.

Natural key: (name, country).  Detail columns: latitude, longitude and the
name each API reports.  The dimension is versioned by the caller (write the
returned frame to a new path); nothing here overwrites a path it reads.

Ids are a function of the natural key, so a rerun with other places answering
gives every place the id it had, and stored facts stay valid.  Two keys with
one id are told apart once, and the place registry keeps the answer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obslake import schemas
from obslake.functions.paths import at
from obslake.operators.dedupe import dedupe
from obslake.specs import PAYLOAD, FeedSpec

KEY = list(schemas.DIMENSION_KEY)
DETAILS = list(schemas.DIMENSION_DETAILS)
COLUMNS = ["place_id", *KEY, *DETAILS]

# Hex digits of the key's md5 that make an id: 60 bits, a positive long.
ID_DIGITS = 15


def feed_candidates(parsed: DataFrame, spec: FeedSpec) -> DataFrame:
    """One candidate per (name, country) from one parsed feed (first request
    wins), with the details this feed knows."""
    p = F.col(PAYLOAD)
    rows = parsed.select(
        F.col("place_name").alias("name"),
        "country",
        at(p, spec.latitude).cast("double").alias("latitude"),
        at(p, spec.longitude).cast("double").alias("longitude"),
        at(p, spec.api_name).alias(spec.dimension_name_column),
        "rank",
    )
    return dedupe(rows, KEY, "rank")


def place_candidates(parsed_feeds: Sequence[tuple[DataFrame, FeedSpec]]) -> DataFrame:
    """Full outer join of per-feed candidates on the natural key.

    Coordinates come from the first feed (in the given order) that has them.
    Each side is already unique on the key, so the join moves one row per
    place and needs no dedupe after it.
    """
    merged = None
    for i, (parsed, spec) in enumerate(parsed_feeds):
        c = feed_candidates(parsed, spec).withColumnsRenamed(
            {"latitude": f"_lat{i}", "longitude": f"_lon{i}"})
        merged = c if merged is None else merged.join(c, KEY, "full")
    n = len(parsed_feeds)
    present = set(merged.columns)
    return merged.select(
        *KEY,
        F.coalesce(*[F.col(f"_lat{i}") for i in range(n)]).alias("latitude"),
        F.coalesce(*[F.col(f"_lon{i}") for i in range(n)]).alias("longitude"),
        *[(F.col(c) if c in present else F.lit(None).cast("string")).alias(c)
          for c in ("air_name", "weather_name")],
    ).where(F.col("name").isNotNull())


def new_places(candidates: DataFrame, existing: DataFrame) -> DataFrame:
    """Candidates whose natural key is not in the dimension yet."""
    return candidates.join(existing.select(*KEY), KEY, "left_anti")


def place_id(name: Column, country: Column, choice: int = 0) -> Column:
    """The id of a place: the first digits of the md5 of its natural key.  A
    later choice takes the next digits and says so in the bits above them, so
    it is never equal to a first one."""
    key = F.concat(name, F.lit("\x1f"), F.coalesce(country, F.lit("")))
    digits = F.substring(F.md5(key.cast("binary")), 1 + ID_DIGITS * min(choice, 1), ID_DIGITS)
    return F.conv(digits, 16, 10).cast("long") + (choice << 4 * ID_DIGITS)


# A place whose first id is taken gets a later choice, up to this one.
LAST_CHOICE = 7


def merge_places(existing: DataFrame, candidates: DataFrame, fill_null: bool = False,
                 registry: DataFrame | None = None) -> DataFrame:
    """The dimension with the candidates it did not know (``is_new``), from
    one join: candidates are computed once.  Known places keep their id and
    details; with ``fill_null`` their null details are filled.

    Places that ``registry`` knows (see :mod:`obslake.operators.registry`) keep
    the id it gives them, and are there also when this dimension version and
    the candidates do not have them: facts may be stored under their ids.

    Where two places have one first id, the one that is stored keeps it, and
    among new ones the first by name and country; the others take a later
    choice of :func:`place_id`, which the registry then keeps.  Two stored
    places with one id fail: facts of both would be mixed up.
    """
    e, c = existing.select(*COLUMNS).alias("e"), candidates.alias("c")
    joined = e.join(c, KEY, "full")
    known = F.col("e.place_id")
    if registry is not None:
        joined = joined.join(registry.select(*KEY, F.col("place_id").alias("known_id")).alias("r"), KEY, "full")
        known = F.coalesce(known, F.col("r.known_id"))
    new = F.col("e.place_id").isNull()
    kept = {d: F.coalesce(F.col(f"e.{d}"), F.col(f"c.{d}")) if fill_null
            else F.when(new, F.col(f"c.{d}")).otherwise(F.col(f"e.{d}")) for d in DETAILS}
    merged = joined.select(
        F.coalesce(known, place_id(F.col("name"), F.col("country"))).alias("place_id"),
        *KEY, *[v.alias(d) for d, v in kept.items()], new.alias("is_new"), known.isNotNull().alias("stored"))
    same_id = Window.partitionBy("place_id").orderBy(F.col("stored").desc(), *KEY)
    ranked = merged.withColumn("choice", F.row_number().over(same_id) - 1)
    clash = F.col("choice") > F.when(F.col("stored"), 0).otherwise(LAST_CHOICE)
    chosen = F.when(clash, F.raise_error(F.concat(
        F.lit("two places have id "), F.col("place_id").cast("string"))).cast("long"))
    for n in range(1, LAST_CHOICE + 1):
        chosen = chosen.when(F.col("choice") == n, place_id(F.col("name"), F.col("country"), n))
    return ranked.select(chosen.otherwise(F.col("place_id")).alias("place_id"), *KEY, *DETAILS, "is_new")


def upsert_places(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """Insert-only upsert: the dimension plus candidates it did not know."""
    return merge_places(existing, candidates).select(*COLUMNS)


def fill_null_details(existing: DataFrame, candidates: DataFrame) -> DataFrame:
    """Upsert, then fill details that are null in the dimension from the
    candidates (stored values are never replaced by new ones)."""
    return merge_places(existing, candidates, fill_null=True).select(*COLUMNS)
