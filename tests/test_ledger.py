"""Hour ledger: expected, landed, loaded; catch-up."""

from __future__ import annotations

import datetime as dt

import pytest

from obslake.operators import ledger
from obslake.sources import raw

from helpers import air, envelope_df

FIRST, LAST = dt.datetime(2024, 1, 1, 22, 30), dt.datetime(2024, 1, 2, 3)


def land(spark, root, hours):
    rows = [{"request_id": i, "payload": air(), "fetched_at_utc": f"2024-01-{d:02d}T{h:02d}:15:00.000Z"}
            for i, (d, h) in enumerate(hours)]
    raw.land(envelope_df(spark, rows), root)


def statuses(spark, root, path):
    return {(r.dt.day, r.hour): r.status for r in ledger.plan(spark, root, path, FIRST, LAST).collect()}


def test_plan_and_catch_up(spark, scratch):
    root, path = scratch("raw"), scratch("ledger")
    hours = [(1, "22"), (1, "23"), (2, "00"), (2, "01"), (2, "02"), (2, "03")]
    assert statuses(spark, root, path) == {h: "missing" for h in hours}
    land(spark, root, [(1, 21), (1, 22), (1, 23), (2, 1), (2, 1), (2, 4)])
    want = dict.fromkeys(hours, "missing") | {(1, "22"): "pending", (1, "23"): "pending", (2, "01"): "pending"}
    assert statuses(spark, root, path) == want

    loaded = []

    def load(env):
        loaded.append(sorted({(r.dt.day, r.hour) for r in env.select("dt", "hour").collect()}))

    assert ledger.catch_up(spark, root, path, FIRST, LAST, load, max_hours=2) == 3
    assert loaded == [[(1, "22"), (1, "23")], [(2, "01")]]  # oldest first, two hours at a time
    assert statuses(spark, root, path) == {h: "done" if s == "pending" else s for h, s in want.items()}
    assert ledger.catch_up(spark, root, path, FIRST, LAST, load) == 0

    land(spark, root, [(1, 23), (2, 0)])  # one anew, one late
    got = statuses(spark, root, path)
    assert got[1, "23"] == "relanded" and got[2, "00"] == "pending" and got[1, "22"] == "done"
    assert ledger.catch_up(spark, root, path, FIRST, LAST, load) == 2
    assert set(statuses(spark, root, path).values()) == {"done", "missing"}


def test_a_load_that_fails_is_not_recorded(spark, scratch):
    root, path = scratch("raw"), scratch("ledger")
    land(spark, root, [(1, 22), (1, 23), (2, 0)])
    seen = []

    def fails_second(env):
        seen.append(env.count())
        if len(seen) == 2:
            raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ledger.catch_up(spark, root, path, FIRST, LAST, fails_second, max_hours=1)
    got = statuses(spark, root, path)
    assert [got[h] for h in ((1, "22"), (1, "23"), (2, "00"))] == ["done", "pending", "pending"]


def test_files_that_land_during_a_load_are_seen_later(spark, scratch):
    root, path = scratch("raw"), scratch("ledger")
    land(spark, root, [(1, 22)])
    ledger.catch_up(spark, root, path, FIRST, LAST, lambda env: land(spark, root, [(1, 22), (1, 22)]))
    assert statuses(spark, root, path)[1, "22"] == "relanded"


def test_no_file_is_opened_for_the_plan(spark, scratch):
    root = scratch("raw")
    land(spark, root, [(1, 22)])
    plan = ledger.landed_hours(spark, root, FIRST.date(), LAST.date())._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]
    assert ledger.expected_hours(spark, LAST, FIRST).count() == 0
