"""As-of lookup against brute force; alert episodes, batch and stream."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from obslake.operators import alert, asof, episodes
from obslake.streaming import episodes as stream_episodes

T0 = dt.datetime(2024, 3, 30, 20)
LEFT = "id int, k string, t timestamp_ntz"
RIGHT = "k string, at timestamp_ntz, v int"


def brute(left, right):
    out = []
    for i, k, t in left:
        seen = [(a, v) for rk, a, v in right if rk == k and None not in (k, a, t) and a <= t]
        out.append((i, k, t, *max(seen, key=lambda r: (r[0], r[1] is not None, r[1] or 0), default=(None, None))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("chunk_hours", [1, 24, 24 * 365])
def test_as_of_equals_brute_force(spark, chunk_hours):
    rng = random.Random(7)

    def when():
        return T0 + dt.timedelta(minutes=rng.randrange(0, 60 * 60) // 7 * 7)

    left = [(i, rng.choice("aaaaabc"), when()) for i in range(200)] + [(900, None, T0), (901, "a", None), (902, "z", T0)]
    right = [(rng.choice("aaaaab"), when(), rng.randrange(5)) for _ in range(120)]
    right += [(None, T0, 1), ("a", None, 2), ("a", T0, None), ("b", T0, 3), ("b", T0, 4)]
    left += left[:2]  # repeated rows stay
    got = asof.as_of(spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), ["k"], "t", "at", ["v"],
                     chunk_hours).collect()
    assert sorted(map(tuple, got), key=repr) == brute(left, right)


def test_as_of_edges(spark):
    left, right = spark.createDataFrame([(1, "a", T0)], LEFT), spark.createDataFrame([], RIGHT)
    assert [tuple(r) for r in asof.as_of(left, right, ["k"], "t", "at", ["v"]).collect()] == [(1, "a", T0, None, None)]
    assert asof.as_of(left.limit(0), right, ["k"], "t", "at", ["v"]).count() == 0
    with pytest.raises(ValueError, match="columns of both sides"):
        asof.as_of(left.withColumn("v", F.lit(1)), right, ["k"], "t", "at", ["v"])


def test_as_of_has_no_join_and_windows_by_chunk(spark):
    left, right = spark.createDataFrame([(1, "a", T0)], LEFT), spark.createDataFrame([("a", T0, 1)], RIGHT)
    plan = asof.as_of(left, right, ["k"], "t", "at", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "SinglePartition" not in plan
    assert "hashpartitioning(_k0" in plan and "_chunk" in plan.split("Window")[1]


def firing(windows):
    """Episodes by hand: minutes that fire, to (start, end, windows, most)."""
    out = []
    for m, n in sorted(windows.items()):
        if out and m <= out[-1][1]:
            out[-1] = (out[-1][0], m + 5, out[-1][2] + 1, max(out[-1][3], n))
        else:
            out.append((m, m + 5, 1, n))
    return out


def minutes(rows):
    def m(t):
        return int((t - T0).total_seconds()) // 60

    return sorted((m(r.episode_start), m(r.episode_end), r.n_windows, r.most_failed) for r in rows)


def test_episodes_merge_windows_that_touch(spark):
    fires = {0: 2, 1: 5, 6: 1, 12: 1, 17: 3, 23: 1, 3000: 1}  # 1 meets 6, 6 and 12 are a minute apart
    rows = [(T0 + dt.timedelta(minutes=m), T0 + dt.timedelta(minutes=m + 5), n, True) for m, n in fires.items()]
    rows.append((T0 + dt.timedelta(minutes=11), T0 + dt.timedelta(minutes=16), 9, False))
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, window_end timestamp_ntz, n_failed bigint, firing boolean")
    assert minutes(episodes.episodes(df).collect()) == firing(fires)
    two = df.withColumn("s", F.lit("x")).unionByName(df.where("n_failed = 1").withColumn("s", F.lit("y")))
    got = episodes.episodes(two, ("s",)).where("s = 'y'")
    assert minutes(got.collect()) == firing({m: n for m, n in fires.items() if n == 1})
    assert episodes.episodes(df.limit(0)).count() == 0


def test_stream_equals_batch_over_many_micro_batches(spark, scratch):
    rng = random.Random(3)
    at = sorted(rng.randrange(0, 60 * 60 * 20) for _ in range(400))
    rows = [(T0 + dt.timedelta(seconds=s + rng.randrange(-500, 1)), rng.random() < 0.5) for s in at]  # up to 500 s late
    folder, root, state = scratch("events"), scratch("episodes"), scratch("ckpt")
    schema = "ts timestamp_ntz, failed boolean"
    version = 0
    for i in range(0, 400, 80):
        spark.createDataFrame(rows[i:i + 80], schema).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(schema).parquet(folder)
        version = max(version, stream_episodes.run_available(source, "ts", F.col("failed"), root, state, delay_minutes=15))
    assert version >= 5
    want = episodes.episodes(alert.failure_alert(spark.createDataFrame(rows, schema), "ts", F.col("failed")))
    got = stream_episodes.read(spark, root, version)
    assert minutes(got.collect()) == minutes(want.collect())
    # closed episodes have left the state
    still = spark.read.parquet(f"{root}/open/v{version}").count()
    assert 0 < still < 60
