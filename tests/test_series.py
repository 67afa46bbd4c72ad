"""Variations and counter increases against brute force, at chunk borders."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from obslake.operators import series

T0 = dt.datetime(2024, 3, 30, 20)


def lower_median(xs):
    return sorted(xs)[(len(xs) - 1) // 2]


@pytest.mark.parametrize("chunk_hours", [24, 24 * 7, 24 * 365])
def test_variations_equal_brute_force(spark, chunk_hours):
    rng = random.Random(2)
    rows = [(rng.choice("aaab"), T0 + dt.timedelta(minutes=rng.randrange(60 * 24 * 6) // 10 * 10), float(rng.randrange(30)))
            for _ in range(300)]
    rows += [("a", T0, 100.0), ("a", T0, 100.0), ("c", T0, 1.0), (None, T0, 5.0), ("a", None, 1.0), ("a", T0, None)]
    # exactly a day apart: still seen
    rows += [("d", T0 + dt.timedelta(days=i), float(i)) for i in range(3)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
    got = sorted(map(tuple, series.variations(df, ["k"], "t", "v", at_least=3, chunk_hours=chunk_hours).collect()), key=repr)
    want = []
    for k, t, v in rows:
        if t is None or v is None:
            continue
        seen = [(s, w) for kk, s, w in rows if kk == k and s is not None and w is not None
                and t - dt.timedelta(hours=24) <= s < t]
        values = [w for _, w in seen]
        delta = v - max(seen)[1] if seen else None
        score = None
        if len(values) >= 3:
            med = lower_median(values)
            spread = lower_median([abs(w - med) for w in values])
            score = (v - med) / (series.NORMAL * spread) if spread else None
        want.append((k, t, v, len(values), delta, score, score is not None and abs(score) > 3.5))
    assert got == sorted(want, key=repr)
    assert any(w[-1] for w in want)


@pytest.mark.parametrize("chunk_hours", [1, 24])
def test_counter_increase_equals_brute_force(spark, chunk_hours):
    rng = random.Random(4)
    rows = []
    for k, n in (("a", 300), ("b", 5), ("c", 1)):
        total = 0
        for s in sorted(rng.sample(range(0, 60 * 60 * 10, 30), n)):
            total = 0 if rng.random() < 0.1 else total + rng.randrange(3)  # restarts
            rows.append((k, T0 + dt.timedelta(seconds=s), total))
    rows += [("a", rows[0][1], 1), ("a", None, 4), ("a", T0, None)]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v bigint")
    got = sorted(map(tuple, series.counter_increase(df, ["k"], "t", "v", chunk_hours=chunk_hours).collect()))
    one = {}
    for k, t, v in rows:
        if t is not None and v is not None:
            one[k, t] = max(v, one.get((k, t), v))
    steps, last = {}, {}
    for (k, t), v in sorted(one.items()):
        p = last.get(k)
        steps[k, t] = 0 if p is None else v - p if v >= p else v
        last[k] = v
    want = [(k, t, v, steps[k, t], sum(x for (kk, tt), x in steps.items() if kk == k and t - dt.timedelta(minutes=5) < tt <= t))
            for (k, t), v in one.items()]
    assert got == sorted(want)


def test_no_window_over_a_whole_series(spark):
    df = spark.createDataFrame([("a", T0, 1)], "k string, t timestamp_ntz, v bigint")
    for found in (series.variations(df, ["k"], "t", "v"), series.counter_increase(df, ["k"], "t", "v")):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "SinglePartition" not in plan and "_chunk" in plan.split("Window")[1]
    with pytest.raises(ValueError, match="as long as"):
        series.variations(df, ["k"], "t", "v", hours=48, chunk_hours=24)
    assert series.variations(df.limit(0), ["k"], "t", "v").count() == 0
