"""Property tests against brute force: percent-encoding vs urllib's quote,
deterministic dedupe vs pandas, alert vs the direct window definition, and
a skewed key (a third of all rows) through lookup + dedupe with broadcast
disabled."""

from __future__ import annotations

import datetime as dt
import random
from urllib.parse import quote

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from obslake import specs
from obslake.functions.urls import percent_encode
from obslake.operators import alert, dedupe, facts, parse

from helpers import air, envelope_df
from test_stream_alert import _brute_force


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(min_size=0, max_size=12), min_size=1, max_size=40))
def test_percent_encode_matches_quote(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r.e for r in df.select(percent_encode(F.col("t")).alias("e")).collect()]
    assert got == [quote(t) for t in texts]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2), st.integers(0, 10_000),
                          st.floats(allow_nan=False, allow_infinity=False, width=32)),
                min_size=1, max_size=60, unique_by=lambda r: r[2]))
def test_dedupe_matches_pandas(spark, rows):
    df = spark.createDataFrame(rows, "a int, b int, o int, v float")
    got = sorted(tuple(r) for r in dedupe.dedupe(df, ["a", "b"], "o", keep_order=True)
                 .select("a", "b", "o", "v").collect())
    pdf = pd.DataFrame(rows, columns=["a", "b", "o", "v"])
    want = pdf.loc[pdf.groupby(["a", "b"])["o"].idxmin()]
    assert got == sorted(tuple(x) for x in want.itertuples(index=False, name=None))


def test_alert_random_against_brute_force(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 3, 31, 0, 30)
    times = [base + dt.timedelta(seconds=rnd.randrange(0, 4 * 3600)) for _ in range(300)]
    ev = spark.createDataFrame([(t, "failed") for t in times], "ts timestamp_ntz, status string")
    got = {tuple(r) for r in alert.failure_alert(ev, "ts").collect()}
    assert got == _brute_force(times)


def test_hot_place_through_shuffle_join(spark):
    """One place holds a third of all rows; lookup forced to a shuffle join
    (AQE skew join may split it); the result must equal the broadcast one."""
    rows = []
    for i in range(3000):
        place = "HOT" if i % 3 == 0 else f"P{i % 97}"
        rows.append({"request_id": i, "place_name": place,
                     "fetched_at_utc": f"2024-01-01T{(i // 500):02d}:00:00.000Z",
                     "payload": air(f'{{"aqi":{i % 50},"time":{{"iso":"2024-01-01T00:00:{i % 60:02d}Z"}}}}')})
    parsed = parse.parse_feed(envelope_df(spark, rows), specs.AIR_QUALITY)
    dim = spark.createDataFrame([(j, n, "FR", None, None, None, None)
                                 for j, n in enumerate(["Hot"] + [f"P{k}" for k in range(97)])],
                                "place_id long, name string, country string, latitude double, "
                                "longitude double, air_name string, weather_name string")
    spec = specs.AIR_QUALITY_CURRENT
    broadcast = facts.current_fact(parsed, dim, spec)
    shuffled = facts.current_fact(parsed, dim, spec)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = shuffled._jdf.queryExecution().executedPlan().toString()
        got = sorted(tuple(r) for r in shuffled.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in plan
    assert got == sorted(tuple(r) for r in broadcast.collect())
    hot = [r for r in broadcast.collect() if r.place_id == 0]
    assert len(hot) == 6  # one row per fetch hour, earliest request kept
    assert all(r.aqi == (min(i for i in range(0, 3000, 3) if i // 500 == h) % 50)
               for h, r in enumerate(sorted(hot, key=lambda r: r.fetched_at)))
