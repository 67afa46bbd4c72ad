"""Run metrics as ordinary DataFrames.

One aggregation pass over the envelope for all feeds instead of a
``count()`` action per step: raw rows, successful responses, valid payloads,
named rows, and rows whose place the dimension knows (the lookup is an inner
join, so the difference is what the facts silently drop).  Rows that no feed's
URL matches are counted too, as feed ``unrouted``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions import names
from obslake.operators.lookup import lookup_table
from obslake.specs import FeedSpec


UNROUTED = "unrouted"
MEASURES = ("raw_rows", "ok_rows", "valid_rows", "named_rows", "matched_rows")


def feeds_metrics(envelope: DataFrame, feeds: Sequence[FeedSpec], dimension: DataFrame) -> DataFrame:
    """One row per feed and one for ``unrouted``, from ONE pass over the
    envelope.

    Each row is routed by its URL host and its payload is parsed with its
    own feed's schema only (the CASE evaluates one ``from_json``).  Rows are
    counted per place before the lookup, so it moves one row per place and
    outcome (a feed or place holding most rows is no hot group); the sums
    are unpivoted, and a feed without rows still gets its row of zeros.
    """
    url = F.col("url")
    feed = valid = country = None
    for f in feeds:
        hit = url.contains(f.url_marker)
        ok_payload = F.coalesce(f.valid(F.from_json(F.col("payload"), f.payload_schema)), F.lit(False))
        own = F.coalesce(F.col("country"), F.lit(f.country))
        feed = (F.when(hit, F.lit(f.name)) if feed is None else feed.when(hit, F.lit(f.name)))
        valid = (F.when(hit, ok_payload) if valid is None else valid.when(hit, ok_payload))
        country = (F.when(hit, own) if country is None else country.when(hit, own))
    name = names.display_name(F.col("place_name"))
    ok = F.coalesce(F.col("ok"), F.lit(False))
    counted = envelope.select(
        F.coalesce(feed, F.lit(UNROUTED)).alias("feed"),
        ok.alias("ok"),
        F.coalesce(valid, F.lit(False)).alias("valid"),
        name.isNotNull().alias("named"),
        names.lookup_key(name).alias("place_key"),
        country.alias("country"),
    ).groupBy("feed", "ok", "valid", "named", "place_key", "country").agg(F.count(F.lit(1)).alias("n"))
    known = lookup_table(dimension).select("place_key", "country", F.lit(True).alias("_known"))
    rows = counted.join(known, ["place_key", "country"], "left")
    ok = F.col("ok")
    usable = ok & F.col("valid") & F.col("named")
    conditions = {
        "raw_rows": F.lit(True),
        "ok_rows": ok,
        "valid_rows": ok & F.col("valid"),
        "named_rows": usable,
        "matched_rows": usable & F.col("_known").isNotNull(),
    }
    order = [*[f.name for f in feeds], UNROUTED]
    counts = rows.agg(*[
        F.coalesce(F.sum(F.when((F.col("feed") == F.lit(f)) & cond, F.col("n"))), F.lit(0)).alias(f"{i}_{m}")
        for i, f in enumerate(order) for m, cond in conditions.items()
    ])
    per_feed = [F.struct(F.lit(f).alias("feed"), *[F.col(f"{i}_{m}").alias(m) for m in MEASURES])
                for i, f in enumerate(order)]
    return counts.select(F.explode(F.array(*per_feed)).alias("m")).select("m.*")


def feed_metrics(envelope: DataFrame, spec: FeedSpec, dimension: DataFrame) -> DataFrame:
    """The metrics row of one feed (rows of other feeds are not counted)."""
    return feeds_metrics(envelope, [spec], dimension).where(F.col("feed") == F.lit(spec.name))
