"""Bucketed stored keys: no exchange of the stored side, recovery."""

from __future__ import annotations

import datetime as dt

import pytest

from obslake.operators import incremental, keytable
from obslake.sources import tables

KEYS = ["place_id", "measured_at"]
SCHEMA = "place_id long, measured_at timestamp_ntz, fetched_at timestamp_ntz, v int"


def batch(spark, hours, day=1, places=(1, 2)):
    return spark.createDataFrame([(p, dt.datetime(2024, 1, 1, h), dt.datetime(2024, 1, day, h), day)
                                  for h in hours for p in places], SCHEMA)


def load(spark, target, rows):
    return incremental.append_unseen(spark, rows, target, KEYS, key_buckets=4)["inserted"]


def test_loads_store_each_key_once(spark, scratch):
    target = scratch("facts")
    assert load(spark, target, batch(spark, range(4))) == 8
    assert load(spark, target, batch(spark, range(6), day=2)) == 4  # built from the facts, then added to
    assert load(spark, target, batch(spark, range(8), day=3)) == 4
    assert load(spark, target, batch(spark, range(8), day=4)) == 0
    rows = [(r.place_id, r.measured_at.hour) for r in spark.read.parquet(target).collect()]
    assert sorted(rows) == [(p, h) for p in (1, 2) for h in range(8)]


def test_stored_side_is_not_exchanged(spark, scratch):
    target = scratch("facts")
    for day in (1, 2):
        load(spark, target, batch(spark, range(4 * day), day))
    name, buckets = keytable.opened(spark, target, spark.read.parquet(target), KEYS)
    assert buckets == 4
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        marked = incremental.mark_stored(batch(spark, range(3)).repartition(buckets, *KEYS), spark.table(name), KEYS)
        plan = marked._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert plan.count("Exchange") == 1 and "ExistenceJoin" in plan and "Bucketed: true" in plan
    assert "Exchange" not in plan[:plan.index("FileScan")].rsplit("Sort", 1)[1]


def test_a_load_that_died_between_facts_and_keys(spark, scratch, monkeypatch):
    target = scratch("facts")
    for day in (1, 2):
        load(spark, target, batch(spark, range(4 * day), day))

    def dies(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(keytable, "add", dies)
        with pytest.raises(RuntimeError):
            load(spark, target, batch(spark, range(12), day=3))
    assert spark.read.parquet(target).count() == 24  # stored, but their keys are not
    assert load(spark, target, batch(spark, range(12), day=3)) == 0  # built again from the facts
    assert not tables.exists(spark, f"{target}_keys/{keytable.MARKER}")


def test_null_keys_and_a_new_session(spark, scratch):
    target = scratch("facts")
    load(spark, target, batch(spark, range(2)))
    load(spark, target, batch(spark, range(3), day=2))
    name, _ = keytable.opened(spark, target, spark.read.parquet(target), KEYS)
    spark.sql(f"DROP TABLE {name}")  # what a session without a metastore starts from
    assert load(spark, target, batch(spark, range(3), day=3)) == 0
    odd = spark.createDataFrame([(None, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 5), 5)], SCHEMA)
    assert load(spark, target, odd) == 1 and load(spark, target, batch(spark, range(3), day=6)) == 0
