"""Rejected rows: what a load does not use, and why.

One pass over the envelopes gives every row an array of reasons; a row with
none is accepted.  So accepted and rejected rows together are the raw rows,
and each is exactly one of the two.  All reasons of a row are listed, in the
order of the checks:

* ``bad_line``       the landed line is not an envelope (or a field of it has
  the wrong type); the line itself is kept
* ``unrouted``       the URL belongs to no feed
* ``no_answer``      no HTTP answer (status 0 or none)
* ``http_error``     an answer other than 200
* ``bad_json``       the body of a good answer is not a whole JSON object
* ``bad_payload``    the feed's validity rule fails
* ``no_place``       no place name
* ``no_fetch_time``  no readable fetch time
* ``no_event_time``  the feed's event-time rule gives nothing

A payload field of the wrong type does not reject the row: it becomes null
and its siblings survive, as in the load.  Such rows are accepted with
``bad_field`` among their ``notes``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake import schemas
from obslake.functions import names
from obslake.functions import time as tf
from obslake.operators import parse
from obslake.sources import raw, tables
from obslake.specs import FeedSpec

LINE = "_line"  # corrupt-record column of the scan
CHECKS = ("bad_line", "unrouted", "no_answer", "http_error", "bad_json", "bad_payload", "no_place", "no_fetch_time",
          "no_event_time")


def read_lines(spark: SparkSession, root: str) -> DataFrame:
    """Landed JSON envelopes with ``_line``: the text of a line that does not
    parse as one, null for the others."""
    return (spark.read.schema(f"{schemas.RAW_TABLE}, {LINE} STRING").option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", LINE).json(root))


def _of_feed(feeds: Sequence[FeedSpec], value) -> Column:
    """``value(spec)`` of the feed that a row is routed to, else null."""
    found = None
    for spec in feeds:
        hit = F.col("_feed") == F.lit(spec.name)
        found = F.when(hit, value(spec)) if found is None else found.when(hit, value(spec))
    return found


def classify(envelope: DataFrame, feeds: Sequence[FeedSpec]) -> DataFrame:
    """``envelope`` (with or without ``_line``) with ``reasons``, empty for
    accepted rows, and ``notes``.  Narrow: no shuffle, each body parsed once
    with the schema of its own feed."""
    line = F.col(LINE).isNotNull() if LINE in envelope.columns else F.lit(False)
    routed = reduce(lambda c, f: c.when(F.col("url").contains(f.url_marker), F.lit(f.name)), feeds[1:],
                    F.when(F.col("url").contains(feeds[0].url_marker), F.lit(feeds[0].name)))
    ok = F.coalesce(F.col("ok"), F.lit(False))
    bodies = {f"_b_{f.name}": F.when(ok & (F.col("_feed") == F.lit(f.name)), parse.parse_body(F.col("payload"), f))
              for f in feeds}
    parsed = parse.once(envelope.withColumn("_feed", routed),
                        {**bodies, "_fetched": tf.parse_instant(F.col("fetched_at_utc"))})

    def body(spec: FeedSpec) -> Column:
        return F.col(f"_b_{spec.name}")

    def not_parsed(spec: FeedSpec) -> Column:
        return body(spec)[parse.TEXT].isNotNull()

    def no_object(spec: FeedSpec) -> Column:
        return body(spec).isNull() | F.when(not_parsed(spec), ~parse.is_object(F.col("payload"))).otherwise(F.lit(False))

    fetched = F.col("_fetched")
    not_json = F.coalesce(_of_feed(feeds, no_object), F.lit(False))
    valid = F.coalesce(_of_feed(feeds, lambda f: f.valid(body(f))), F.lit(False))
    event = _of_feed(feeds, lambda f: f.event_time(body(f), fetched))
    answered = F.coalesce(F.col("http_status"), F.lit(0)) != 0
    usable = ok & F.col("_feed").isNotNull()
    failed = {
        "bad_line": line,
        "unrouted": ~line & F.col("_feed").isNull(),
        "no_answer": ~line & ~ok & ~answered,
        "http_error": ~line & ~ok & answered,
        "bad_json": usable & not_json,
        "bad_payload": usable & ~not_json & ~valid,
        "no_place": ~line & names.display_name(F.col("place_name")).isNull(),
        "no_fetch_time": ~line & fetched.isNull(),
        "no_event_time": usable & ~not_json & valid & event.isNull(),
    }
    reasons = F.array_except(F.array(*[F.when(failed[c], F.lit(c)) for c in CHECKS]), F.array(F.lit(None).cast("string")))
    partly = usable & ~not_json & F.coalesce(_of_feed(feeds, not_parsed), F.lit(False))
    notes = F.when(partly, F.array(F.lit("bad_field"))).otherwise(F.array().cast("array<string>"))
    return parsed.withColumns({"reasons": reasons, "notes": notes}).drop("_feed", "_fetched", *bodies)


def split(envelope: DataFrame, feeds: Sequence[FeedSpec]) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected): the accepted envelopes as they were, and the
    rejected ones with ``reasons`` and their line."""
    all_rows = classify(envelope, feeds)
    none = F.size("reasons") == 0
    return all_rows.where(none).drop("reasons", "notes", LINE), all_rows.where(~none).drop("notes")


def counts(classified: DataFrame, noted: bool = False) -> DataFrame:
    """Rows by ``reason``; a row with several counts for each, accepted rows
    as ``accepted``, and all rows as ``raw``.  With ``noted`` accepted rows
    count for ``accepted, <note>`` too, in the same pass."""
    accepted = F.array(F.lit("accepted"))
    if noted:
        accepted = F.concat(accepted, F.transform("notes", lambda n: F.concat(F.lit("accepted, "), n)))
    named = F.when(F.size("reasons") == 0, accepted).otherwise(F.col("reasons"))
    return (classified.select(F.explode(F.concat(named, F.array(F.lit("raw")))).alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("rows")))


def store(rejected: DataFrame, target: str) -> None:
    """Write rejected rows by day of their landing folder, replacing the days
    they have (a rerun of an hour's day replaces what it rejected before).
    Rows without a folder go to the null day."""
    keyed = rejected if "dt" in rejected.columns else raw.with_partition_keys(rejected)
    with tables.compiled(rejected.sparkSession):
        (keyed.hint("rebalance", "dt").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("dt").parquet(target))


def stored(spark: SparkSession, target: str) -> DataFrame:
    """What :func:`store` left; no rows before its first run."""
    ddl = f"{schemas.ENVELOPE}, hour STRING, {LINE} STRING, reasons ARRAY<STRING>, dt DATE"
    if not tables.exists(spark, target):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(target)
