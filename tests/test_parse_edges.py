"""Edge payloads (bad fields, non-JSON bodies, out-of-range positions,
unparsable times, offsets, clock changes, names)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from obslake import specs
from obslake.functions import names
from obslake.functions import time as tf
from obslake.operators import parse

from helpers import air, envelope_df

A, B = specs.AIR_QUALITY, specs.WEATHER


def _parse_a(spark, rows):
    return parse.parse_feed(envelope_df(spark, rows), A)


def test_bad_field_only_nulls_that_field(spark):
    (r,) = _parse_a(spark, [{"payload": air('{"aqi":"-","dominentpol":"o3"}')}]).collect()
    assert r.p.data.aqi is None and r.p.data.dominentpol == "o3"


def test_fractional_int_is_null(spark):
    (r,) = _parse_a(spark, [{"payload": air('{"aqi":12.0,"idx":1}')}]).collect()
    assert r.p.data.aqi is None


def test_invalid_bodies_are_dropped(spark):
    rows = [
        {"payload": '{"status":"error","data":"Unknown station"}'},
        {"payload": "ERROR: timeout"},
        {"payload": ""},
        {"payload": None},
        {"payload": '{"status":"ok","data":{"aqi":1'},
        {"payload": air('{"aqi":1}'), "ok": None},
        {"payload": air('{"aqi":1}'), "place_name": None},
    ]
    assert _parse_a(spark, rows).count() == 0


def test_string_status_code_is_dropped(spark):
    env = envelope_df(spark, [{"feed": "weather", "payload": '{"cod":"404","name":"x"}'},
                              {"feed": "weather", "payload": '{"cod":200,"name":"x","dt":0}'}])
    assert parse.parse_feed(env, B).count() == 1


def test_positions_out_of_range_are_null(spark):
    env = envelope_df(spark, [{"feed": "weather",
                               "payload": '{"cod":200,"weather":[],"dt":1}'}])
    (r,) = parse.parse_feed(env, B).select(
        F.get(F.col("p.weather"), 0)["id"].alias("code")).collect()
    assert r.code is None
    (g,) = _parse_a(spark, [{"payload": air('{"city":{"geo":[45.7]}}')}]).select(
        F.get(F.col("p.data.city.geo"), 1).alias("lon"),
        F.get(F.col("p.data.city.geo"), 0).alias("lat")).collect()
    assert g.lon is None and g.lat == 45.7


def test_geo_of_strings_is_null(spark):
    (r,) = _parse_a(spark, [{"payload": air('{"city":{"geo":["1","2"]}}')}]).collect()
    assert r.p.data.city.geo is None


def test_event_time_fallback_and_offset(spark):
    rows = [
        {"request_id": 1, "payload": air('{"time":{"iso":"2024-10-27T03:30:00+02:00"}}')},
        {"request_id": 2, "payload": air('{"time":{"iso":"bad"}}')},
        {"request_id": 3, "payload": air('{"aqi":1}')},
    ]
    got = {r.request_id: r.measured_at for r in _parse_a(spark, rows).collect()}
    assert got[1] == dt.datetime(2024, 10, 27, 1, 30)         # offset honoured
    assert got[2] == dt.datetime(2024, 10, 27, 1, 0)          # unparsable -> fetch time
    assert got[3] == dt.datetime(2024, 10, 27, 1, 0)          # absent -> fetch time


def test_epoch_event_time_exact_across_clock_change(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Paris")
    try:
        env = envelope_df(spark, [
            {"feed": "weather", "request_id": i, "payload": f'{{"cod":200,"dt":{e}}}'}
            for i, e in enumerate((1729990800, 1729992600, 1729994400))])
        got = sorted(r.measured_at for r in parse.parse_feed(env, B).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == [dt.datetime(2024, 10, 27, 1, 0), dt.datetime(2024, 10, 27, 1, 30),
                   dt.datetime(2024, 10, 27, 2, 0)]


def test_display_name_splits_on_whitespace_only(spark):
    (r,) = spark.createDataFrame([("  clermont-FERRAND ",)], "n string").select(
        names.display_name(F.col("n")).alias("d"), names.lookup_key(F.col("n")).alias("k")).collect()
    assert r.d == "Clermont-ferrand" and r.k == "CLERMONT-FERRAND"


def test_time_helpers_ignore_session_zone(spark):
    df = spark.sql("select timestamp_ntz'2024-03-10 02:30:15.123456' as ts "
                   "union all select timestamp_ntz'2024-07-01 12:00:00.999'")
    outs = []
    for zone in ("UTC", "America/New_York", "Europe/Paris"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        outs.append(df.select(tf.format_utc_iso(F.col("ts")).alias("iso"),
                              tf.utc_epoch_micros(F.col("ts")).alias("us"),
                              tf.floor_to(F.col("ts"), "hour").alias("h"),
                              tf.parse_instant(tf.format_utc_iso(F.col("ts"))).alias("back"),
                              *tf.partition_keys(F.col("ts"), "Europe/Paris")).collect())
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert outs[0] == outs[1] == outs[2]
    assert outs[0][0].iso == "2024-03-10T02:30:15.123Z"
    assert outs[0][0].us == 1710037815123456
    assert outs[0][1].back == dt.datetime(2024, 7, 1, 12, 0, 0, 999000)
