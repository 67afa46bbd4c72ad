"""Envelopes staged with their bodies parsed: JSON is read once, at landing.

A landed body is text, and every query that looks into it parses it again.
Staged, it is a ``variant``: each successful body is parsed once while it
lands, and what a feed's schema asks for is taken out of the binary form later,
by any number of queries, without a JSON parser.

Fields that do not fit the schema's type are null, as with ``from_json``; a
number in quotes is read as a number here.  Bodies that are no whole JSON have
no variant and keep their text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake import schemas
from obslake.functions import names
from obslake.functions import time as tf
from obslake.specs import PAYLOAD, FeedSpec

BODY = "body"
STAGED = schemas.ddl(f"{schemas.ENVELOPE_DDL}, {BODY} VARIANT, payload_hash BIGINT, {schemas.PARTITION_DDL}")


def stage(envelope: DataFrame) -> DataFrame:
    """``envelope`` with ``body`` (variant; null where the request failed or
    the text is no whole JSON) and ``payload_hash``; ``payload`` stays only
    where there is no ``body``."""
    body = F.when(F.col("ok"), F.try_parse_json("payload"))
    parsed = envelope.withColumns({BODY: body, "payload_hash": F.xxhash64("payload")})
    return parsed.withColumn("payload", F.when(F.col(BODY).isNull(), F.col("payload")))


def parse_staged(staged: DataFrame, spec: FeedSpec) -> DataFrame:
    """Successful responses with the columns of
    :func:`obslake.operators.parse.parse_payload`."""
    struct = F.try_variant_get(F.col(BODY), "$", f"STRUCT<{schemas.struct_fields(spec.payload_schema)}>")
    return staged.where(F.col("ok") & F.col("url").contains(spec.url_marker)).select(
        "request_id",
        names.display_name(F.col("place_name")).alias("place_name"),
        tf.parse_instant(F.col("fetched_at_utc")).alias("fetched_at"),
        F.struct("request_id", "payload_hash").alias("rank"),
        "country",
        struct.alias(PAYLOAD),
    )
