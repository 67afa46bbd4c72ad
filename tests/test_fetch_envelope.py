"""Fetch contract: 200 -> ok; 500 -> HTTP_500; network error -> text kept.

The fetch hook runs on executors (mapInArrow); the HTTP client is injected.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from obslake import specs
from obslake.sources import fetch, raw


def _requests(spark, urls):
    return spark.createDataFrame([("air_quality", "Paris", u) for u in urls],
                                 "feed string, place_name string, url string")


def _envelope(spark, fetcher, urls=("http://stub.invalid/?token=abc",)):
    resp = fetch.fetch_all(_requests(spark, urls), fetcher, parallelism=2)
    resp = resp.withColumn("fetched_at", F.lit("2024-01-01 10:00:00").cast("timestamp_ntz"))
    return raw.envelope(resp).collect()


# What a client answers (or raises), and what the envelope says of it.
ANSWERS = [
    ((200, '{"aqi": 3}'), True, 200, None, '{"aqi": 3}'),
    ((200, None), True, 200, None, None),
    ((404, "gone"), False, 404, "HTTP_404", "gone"),
    ((500, None), False, 500, "HTTP_500", None),
    ((0, "no route"), False, 0, "no route", "no route"),
    (ConnectionError("refused https://h/?q=1&token=abc now"), False, 0,
     "ERROR: refused https://h/?q=1&token=*** now", "ERROR: refused https://h/?q=1&token=*** now"),
    ((403, "bad key: /x?appid=abc\tend"), False, 403, "HTTP_403", "bad key: /x?appid=***\tend"),
]


@pytest.mark.parametrize("answer, ok, status, error, payload", ANSWERS)
def test_envelope_of_an_answer(spark, answer, ok, status, error, payload):
    def client(url):
        if isinstance(answer, Exception):
            raise answer
        return answer
    (row,) = _envelope(spark, client)
    assert (row.ok, row.http_status, row.error, row.payload) == (ok, status, error, payload)
    assert row.url == "http://stub.invalid/?token=***"


@pytest.mark.parametrize("concurrency", [1, 3])
def test_a_call_that_hangs_is_a_network_error(spark, concurrency):
    def client(url):
        import time
        if "slow" in url:
            time.sleep(60)
        return 200, url
    urls = ["http://h/slow", "http://h/a", "http://h/b"]
    resp = fetch.fetch_all(_requests(spark, urls), client, parallelism=1, concurrency=concurrency, deadline=0.5)
    got = {r.url: (r.http_status, r.body) for r in resp.collect()}
    assert got == {urls[0]: (0, "ERROR: no answer within 0.5 s"), urls[1]: (200, urls[1]), urls[2]: (200, urls[2])}


def test_secrets_redacted_and_stamp_iso(spark):
    (row,) = _envelope(spark, lambda url: (200, "{}"),
                       urls=("https://h/x?q=a&appid=SECRET&units=metric",))
    assert "SECRET" not in row.url and "appid=***" in row.url
    assert row.fetched_at_utc == "2024-01-01T10:00:00.000Z"


def test_manifest_fails_fast_without_token(spark):
    places = spark.createDataFrame([("Paris",)], "place_name string")
    with pytest.raises(ValueError):
        fetch.manifest(places, [specs.AIR_QUALITY], {"air_quality": None})


def test_manifest_urls_match_python_quote(spark):
    from urllib.parse import quote

    names = ["Paris", "Clermont-Ferrand", "Le Havre", "Saint-Étienne", "a/b~c*d+e"]
    places = spark.createDataFrame([(n,) for n in names], "place_name string")
    got = {(r.place_name, r.feed): r.url for r in
           fetch.manifest(places, [specs.AIR_QUALITY, specs.WEATHER],
                          {"air_quality": "T1", "weather": "T2"}).collect()}
    for n in names:
        assert got[(n, "air_quality")] == f"https://api.waqi.info/feed/{quote(n)}/?token=T1"
        assert got[(n, "weather")] == (
            "https://api.openweathermap.org/data/2.5/weather?q="
            f"{quote(n + ',fr')}&appid=T2&units=metric&lang=fr")


class _SlowClient:
    """Stand-in client that reports how many calls were in flight when each
    started (its lock and counter are made fresh in the Python worker)."""

    def __init__(self):
        self.__setstate__({})

    def __getstate__(self):
        return {}

    def __setstate__(self, state):
        import threading
        self.lock, self.in_flight = threading.Lock(), 0

    def __call__(self, url):
        import time
        with self.lock:
            self.in_flight += 1
            seen = self.in_flight
        try:
            time.sleep(0.05)
            n = int(url.rsplit("=", 1)[1])
            if n % 7 == 0:
                raise TimeoutError("timeout")
            return 200, f"{n}/{seen}"
        finally:
            with self.lock:
                self.in_flight -= 1


def test_concurrent_fetch_keeps_answers_and_order(spark):
    urls = [f"http://stub.invalid/?n={i}" for i in range(40)]
    got = fetch.fetch_all(_requests(spark, urls).coalesce(1), _SlowClient(), concurrency=8).collect()
    assert [r.url for r in got] == urls
    for i, r in enumerate(got):
        if i % 7 == 0:
            assert (r.http_status, r.body) == (0, "ERROR: timeout")
        else:
            assert r.http_status == 200 and r.body.split("/")[0] == str(i)
    assert max(int(r.body.split("/")[1]) for r in got if r.http_status == 200) > 1
