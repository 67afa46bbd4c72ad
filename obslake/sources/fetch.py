"""Request manifest and the distributed fetch hook.

The manifest is ``places x feeds``: the feeds are a short fixed list, so it
is one generator over a literal array of feed descriptors per place (no
join).  Fetching runs on the executors with ``mapInArrow`` (Arrow batches,
not rows), after spreading the manifest over ``parallelism`` partitions; the
HTTP client itself is injected (``fetch(url) -> (status, text)``).
"""

from __future__ import annotations

import threading
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obslake.functions.urls import fill_template, percent_encode
from obslake.specs import FeedSpec

DEADLINE = 30.0  # seconds for one request
RESPONSE_SCHEMA = ("request_id long, feed string, place_name string, url string, "
                   "http_status int, body string, country string")


def manifest(places: DataFrame, feeds: Sequence[FeedSpec], tokens: dict[str, str],
             place_col: str = "place_name", country_col: str | None = None) -> DataFrame:
    """One request per (place, feed) with its URL.

    The place is percent-encoded like Python's ``quote`` (the weather feed
    queries ``place,country``); its country goes along.  A missing token fails here, at planning
    time, instead of sending the text ``None``.
    """
    missing = [f.name for f in feeds if not tokens.get(f.name)]
    if missing:
        raise ValueError(f"no API token for feed(s): {', '.join(missing)}")
    place = F.col(place_col)
    country = F.lower(F.col(country_col)) if country_col else None
    options = []
    for f in feeds:
        q = place if f.name != "weather" else F.concat_ws(
            ",", place, country if country is not None else F.lit(f.country.lower()))
        url = fill_template(f.url_template, place=percent_encode(q), token=F.lit(tokens[f.name]))
        options.append(F.struct(F.lit(f.name).alias("feed"), url.alias("url")))
    given = F.col(country_col) if country_col else F.lit(None)
    return places.select(place.alias("place_name"), given.cast("string").alias("country"),
                         F.explode(F.array(*options)).alias("r")) \
                 .select("place_name", "r.feed", "r.url", "country")


def _call(fetch: Callable[[str], tuple[int, str]], url: str) -> tuple[int, str]:
    try:
        s, t = fetch(url)
        return int(s), t
    except Exception as exc:  # network error: status 0 + text
        return 0, f"ERROR: {exc}"


def _call_within(fetch: Callable[[str], tuple[int, str]], url: str, deadline: float | None) -> tuple[int, str]:
    """``_call`` with an answer after ``deadline`` seconds at the latest: a
    call that hangs is left to its own (daemon) thread."""
    if deadline is None:
        return _call(fetch, url)
    answer: list[tuple[int, str]] = []
    t = threading.Thread(target=lambda: answer.append(_call(fetch, url)), daemon=True)
    t.start()
    t.join(deadline)
    return answer[0] if answer else (0, f"ERROR: no answer within {deadline:g} s")


def _fetch_batches(fetch: Callable[[str], tuple[int, str]], concurrency: int = 1,
                   deadline: float | None = None):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One pool per task: requests are I/O-bound, so a task keeps up to
        # ``concurrency`` of them in flight; answers keep the batch order.
        pool = ThreadPoolExecutor(concurrency) if concurrency > 1 else None
        try:
            for batch in batches:
                cols = batch.to_pydict()
                urls = cols["url"]
                answers = (list(pool.map(lambda u: _call_within(fetch, u, deadline), urls)) if pool
                           else [_call_within(fetch, u, deadline) for u in urls])
                yield pa.RecordBatch.from_pydict({
                    "request_id": cols["request_id"], "feed": cols["feed"],
                    "place_name": cols["place_name"], "url": urls,
                    "http_status": pa.array([a[0] for a in answers], pa.int32()),
                    "body": pa.array([a[1] for a in answers], pa.string()),
                    "country": pa.array(cols["country"], pa.string()),
                })
        finally:
            if pool is not None:
                pool.shutdown(wait=True)
    return run


def fetch_all(requests: DataFrame, fetch: Callable[[str], tuple[int, str]],
              parallelism: int | None = None, concurrency: int = 1,
              deadline: float | None = DEADLINE) -> DataFrame:
    """Call ``fetch`` for every request, spread over the executors, with up
    to ``concurrency`` requests in flight per task.  A request without an
    answer after ``deadline`` seconds counts as a network error.

    ``requests`` needs ``feed, place_name, url``; a stable ``request_id`` is
    derived from the URL when absent.
    """
    if "request_id" not in requests.columns:
        requests = requests.withColumn("request_id", F.xxhash64("feed", "url"))
    if "country" not in requests.columns:
        requests = requests.withColumn("country", F.lit(None).cast("string"))
    requests = requests.select("request_id", "feed", "place_name", "url", "country")
    if parallelism:
        requests = requests.repartition(parallelism, "request_id")
    return requests.mapInArrow(_fetch_batches(fetch, concurrency, deadline), RESPONSE_SCHEMA)
