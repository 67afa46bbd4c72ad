"""The raw job: manifest -> distributed fetch -> envelope -> landed hour."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake import specs
from obslake.functions import time as tf
from obslake.operators.parse import route_feed
from obslake.sources import fetch, raw, tables


def run(spark: SparkSession, places: DataFrame, tokens: dict[str, str],
        raw_root: str | Mapping[str, str],
        fetcher: Callable[[str], tuple[int, str]], fetched_at_iso: str,
        feeds: Sequence[specs.FeedSpec] = (specs.AIR_QUALITY, specs.WEATHER),
        parallelism: int | None = None, zone: str = "UTC", country_col: str | None = None,
        concurrency: int = 1, deadline: float | None = fetch.DEADLINE) -> None:
    """Fetch every (place, feed) once and land the hour.

    ``fetched_at_iso`` is the run's single fetch stamp (ISO with offset), so
    (place, fetch time) is unique per run and a silver rerun is idempotent.
    Re-landing the same hour replaces only that hour's partitions.
    ``raw_root`` is one root for all feeds, or one root per feed name; with
    several roots the responses are checkpointed first (shared folder) so
    the second write cannot call the APIs again.
    """
    requests = fetch.manifest(places, feeds, tokens, country_col=country_col)
    responses = fetch.fetch_all(requests, fetcher, parallelism, concurrency, deadline).withColumn(
        "fetched_at", tf.parse_instant(F.lit(fetched_at_iso)))
    env = raw.envelope(responses)
    if isinstance(raw_root, str):
        raw.land(env, raw_root, zone=zone)
        return
    tables.shared_dir(spark)  # make sure a checkpoint folder is set
    env = env.checkpoint(eager=True)
    for f in feeds:
        raw.land(route_feed(env, f), raw_root[f.name], zone=zone)
