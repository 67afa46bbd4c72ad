"""Envelope -> parsed, validated, time-stamped feed rows (narrow: no shuffle).

Two steps, so a job can persist the parsed payloads in between:

* :func:`parse_payload` keeps successful responses and parses the body
  (projection only);
* :func:`validate` applies the feed's validity predicate, the name check and
  the event-time rule.

Composed lazily (:func:`parse_feed`), Catalyst pushes the validity filter
below the projection and evaluates a pruned ``from_json`` (status only) there
as well.  The silver job persists the output of :func:`parse_payload`
instead, so every payload is tokenized exactly once per job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from obslake.functions import names
from obslake.functions import time as tf
from obslake.specs import PAYLOAD, FeedSpec

# Columns of a parsed feed, in order.
PARSED_COLUMNS = (
    "request_id", "place_name", "place_key", "country",
    "fetched_at", "measured_at", "rank", PAYLOAD,
)


def rank_of(request_id: Column, payload: Column) -> Column:
    """Deterministic dedupe order: earliest request first, payload hash as
    tie-break (so a re-landed copy without ids still orders the same)."""
    return F.struct(request_id.alias("request_id"), F.xxhash64(payload).alias("payload_hash"))


# Field of a parsed body that holds its text where something did not parse.
TEXT = "_not_parsed"


def is_object(payload: Column) -> Column:
    """Whether a body is a whole JSON object."""
    return F.coalesce(F.get_json_object(payload, "$").startswith("{"), F.lit(False))


def parse_body(payload: Column, spec: FeedSpec) -> Column:
    """A body parsed with its feed's schema; ``_not_parsed`` is the text of one
    of which something did not parse."""
    return F.from_json(payload, f"{spec.payload_schema}, {TEXT} STRING", {"columnNameOfCorruptRecord": TEXT})


def whole_body(body: Column, payload: Column) -> Column:
    """A parsed body without its text, null where it is cut short: its first
    fields are read then, and a plan that prunes the schema would read other
    ones.  Only a body of which something did not parse is looked at again."""
    return F.when(body[TEXT].isNull() | is_object(payload), body.dropFields(TEXT))


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``df`` with ``columns`` that are evaluated once a row, whatever is done
    with them: a projection builds them, a generator of one row hands them on.
    A filter on a plain column is moved below it, and evaluates the expression
    anew for each of its uses there."""
    built = df.withColumns({f"_{name}": c for name, c in columns.items()})
    return built.select(*df.columns, F.inline(F.array(F.struct(*[F.col(f"_{name}").alias(name) for name in columns]))))


def parse_payload(envelope: DataFrame, spec: FeedSpec, persisted: bool = False) -> DataFrame:
    """Successful responses (``ok`` true; null is dropped) with the payload
    parsed PERMISSIVE against the feed's explicit schema: a bad field becomes
    null and its siblings survive; a non-JSON body is an all-null struct.
    The raw text is replaced by its hash, so a persisted result stays small.
    ``persisted`` says that the result is kept as it is: whole bodies are then
    told from those cut short, which a lazy plan sees by itself.
    """
    if persisted:
        good = envelope.where(F.col("ok")).withColumn("_body", parse_body(F.col("payload"), spec))
        body = whole_body(F.col("_body"), F.col("payload"))
    else:
        good, body = envelope.where(F.col("ok")), F.from_json(F.col("payload"), spec.payload_schema)
    return good.select(
        "request_id",
        names.display_name(F.col("place_name")).alias("place_name"),
        tf.parse_instant(F.col("fetched_at_utc")).alias("fetched_at"),
        rank_of(F.col("request_id"), F.col("payload")).alias("rank"),
        "country",
        body.alias(PAYLOAD),
    )


def parse_payloads(envelope: DataFrame, feeds: Sequence[FeedSpec]) -> DataFrame:
    """Every feed of a mixed envelope in ONE pass.

    Rows are routed by URL host (``feed``); a successful response's payload
    is parsed with its own feed's schema only (one ``from_json`` per row, in
    column ``_p_<feed>``).  Failed responses stay, unparsed, so raw counts
    come from the same pass; so do rows of no feed, with a null ``feed``.
    :func:`feed_rows` takes one feed back out.
    """
    url = F.col("url")
    feed = None
    for f in feeds:
        hit = url.contains(f.url_marker)
        feed = F.when(hit, F.lit(f.name)) if feed is None else feed.when(hit, F.lit(f.name))
    bodies = {f"_b_{f.name}": F.when(F.col("_ok") & (F.col("_feed") == F.lit(f.name)), parse_body(F.col("payload"), f))
              for f in feeds}
    routed = envelope.withColumns({"_feed": feed, "_ok": F.coalesce(F.col("ok"), F.lit(False))}).withColumns(bodies)
    return routed.select(
        F.col("_feed").alias("feed"),
        F.col("_ok").alias("ok"),
        "request_id",
        names.display_name(F.col("place_name")).alias("place_name"),
        tf.parse_instant(F.col("fetched_at_utc")).alias("fetched_at"),
        rank_of(F.col("request_id"), F.col("payload")).alias("rank"),
        "country",
        *[whole_body(F.col(f"_b_{f.name}"), F.col("payload")).alias(f"_p_{f.name}") for f in feeds],
    )


def feed_rows(parsed_all: DataFrame, spec: FeedSpec) -> DataFrame:
    """One feed's successful responses out of :func:`parse_payloads`, with
    the columns of :func:`parse_payload`."""
    return parsed_all.where((F.col("feed") == F.lit(spec.name)) & F.col("ok")).select(
        "request_id", "place_name", "fetched_at", "rank", "country", F.col(f"_p_{spec.name}").alias(PAYLOAD))


def validate(parsed: DataFrame, spec: FeedSpec, country: str | None = None) -> DataFrame:
    """Valid payloads with a display name; adds the lookup key, the country
    (that of the request, else the feed's) and ``measured_at`` (UTC wall
    clock, spec's event-time rule)."""
    p = F.col(PAYLOAD)
    return parsed.where(spec.valid(p) & F.col("place_name").isNotNull()).select(
        "request_id",
        "place_name",
        names.lookup_key(F.col("place_name")).alias("place_key"),
        F.coalesce(F.col("country"), F.lit(country or spec.country)).alias("country"),
        "fetched_at",
        spec.event_time(p, F.col("fetched_at")).alias("measured_at"),
        "rank",
        PAYLOAD,
    )


def parse_feed(envelope: DataFrame, spec: FeedSpec, country: str | None = None) -> DataFrame:
    """:func:`parse_payload` then :func:`validate`, lazily."""
    return validate(parse_payload(envelope, spec), spec, country)


def route_feed(envelope: DataFrame, spec: FeedSpec) -> DataFrame:
    """Rows of one feed out of a mixed envelope, by the URL host marker."""
    return envelope.where(F.col("url").contains(spec.url_marker))
