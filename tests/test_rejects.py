"""Rejected rows: reasons, notes, and that accepted and rejected are all."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from obslake import specs
from obslake.operators import parse, rejects

from helpers import air, envelope_df

FEEDS = [specs.AIR_QUALITY, specs.WEATHER]
WEATHER_URL = "https://api.openweathermap.org/data/2.5/weather?q=x"
GOOD_WEATHER = '{"cod":200,"dt":1700000000}'

# (row, reasons, notes)
CASES = [
    ({"payload": air('{"aqi":3}')}, [], []),
    ({"payload": air('{"aqi":"-"}')}, [], ["bad_field"]),
    ({"payload": "ERROR", "ok": False, "http_status": 0}, ["no_answer"], []),
    ({"payload": None, "ok": False, "http_status": None}, ["no_answer"], []),
    ({"payload": "", "ok": False, "http_status": 503}, ["http_error"], []),
    ({"payload": air('{"aqi":3}'), "ok": None}, ["http_error"], []),
    ({"payload": air('{"aqi":3}')[:-4]}, ["bad_json"], []),  # cut short after the status
    ({"payload": air('{"aqi":3}')[:10]}, ["bad_json"], []),
    ({"payload": ""}, ["bad_json"], []),
    ({"payload": None}, ["bad_json"], []),
    ({"payload": "[1]"}, ["bad_json"], []),
    ({"payload": "null"}, ["bad_json"], []),
    ({"payload": '"text"'}, ["bad_json"], []),
    ({"payload": '{"data":5}'}, ["bad_payload"], ["bad_field"]),
    ({"payload": "{}"}, ["bad_payload"], []),
    ({"payload": air('{"aqi":3}', "error")}, ["bad_payload"], []),
    ({"payload": air(), "place_name": None}, ["no_place"], []),
    ({"payload": air(), "fetched_at_utc": "soon"}, ["no_fetch_time", "no_event_time"], []),
    ({"payload": air('{"time":{"iso":"2024-01-01T00:00:00Z"}}'), "fetched_at_utc": None}, ["no_fetch_time"], []),
    ({"payload": air(), "url": "https://example.org"}, ["unrouted"], []),
    ({"payload": air(), "url": None, "place_name": None, "ok": False, "http_status": 500},
     ["unrouted", "http_error", "no_place"], []),
    ({"payload": GOOD_WEATHER, "url": WEATHER_URL}, [], []),
    ({"payload": '{"cod":200}', "url": WEATHER_URL}, ["no_event_time"], []),
    ({"payload": '{"cod":"404","message":"city not found"}', "url": WEATHER_URL}, ["bad_payload"], ["bad_field"]),
]


def test_every_reason(spark):
    rows = [{"request_id": i, **row} for i, (row, _, _) in enumerate(CASES)]
    got = {r.request_id: (list(r.reasons), list(r.notes)) for r in rejects.classify(envelope_df(spark, rows), FEEDS).collect()}
    assert got == {i: (reasons, notes) for i, (_, reasons, notes) in enumerate(CASES)}


def test_accepted_and_rejected_are_all_and_accepted_is_what_the_load_uses(spark):
    env = envelope_df(spark, [{"request_id": i, **row} for i, (row, _, _) in enumerate(CASES)])
    accepted, rejected = rejects.split(env, FEEDS)
    assert accepted.columns == env.columns
    ids = [r.request_id for r in accepted.collect()] + [r.request_id for r in rejected.collect()]
    assert sorted(ids) == list(range(len(CASES)))
    used = set()
    for spec in FEEDS:
        rows = parse.parse_feed(parse.route_feed(env, spec), spec)
        used |= {r.request_id for r in rows.where("measured_at IS NOT NULL AND fetched_at IS NOT NULL").collect()}
    assert {r.request_id for r in accepted.collect()} == used
    counted = {r.reason: r.rows for r in rejects.counts(rejects.classify(env, FEEDS)).collect()}
    assert counted["raw"] == len(CASES) and counted["accepted"] == len(used)


def test_a_body_that_is_cut_short_is_used_by_no_plan(spark):
    whole = air('{"aqi":3,"iaqi":{"co":{"v":1.5}},"city":{"geo":[1.0,2.0],"name":"x"}}')
    env = envelope_df(spark, [{"request_id": i, "payload": whole[:i]} for i in range(1, len(whole) + 1)])
    spec = specs.AIR_QUALITY
    both = parse.parse_payloads(env, FEEDS).persist()
    one = parse.parse_payload(env, spec, persisted=True).persist()
    try:
        for parsed in (parse.parse_payload(env, spec), one, parse.feed_rows(both, spec)):
            assert [r.request_id for r in parse.validate(parsed, spec).collect()] == [len(whole)]
        assert [r.request_id for r in rejects.split(env, FEEDS)[0].collect()] == [len(whole)]
        assert one.schema["p"].dataType.names == parse.parse_payload(env, spec).schema["p"].dataType.names
    finally:
        both.unpersist()
        one.unpersist()


def test_lines_that_are_no_envelope_are_kept(spark, scratch):
    root, kept = scratch("lines"), scratch("rejected")
    good = {"request_id": 1, "place_name": "Paris", "url": "https://api.waqi.info/feed/x/", "http_status": 200, "ok": True,
            "fetched_at_utc": "2024-01-01T00:00:00.000Z", "payload": air()}
    lines = [json.dumps(good), json.dumps(good)[:40], "not json", json.dumps({**good, "http_status": "two"}), ""]
    spark.createDataFrame([(x, "2024-01-01") for x in lines], "value string, dt string").write.partitionBy("dt").text(root)
    read = rejects.read_lines(spark, root)
    accepted, rejected = rejects.split(read, FEEDS)
    assert accepted.count() == 1
    for _ in range(2):  # a rerun replaces the day
        rejects.store(rejected, kept)
    back = rejects.stored(spark, kept).collect()
    assert sorted(r._line for r in back) == sorted(lines[1:4])
    assert all(r.reasons == ["bad_line"] and str(r.dt) == "2024-01-01" for r in back)
    assert rejects.stored(spark, scratch("none")).count() == 0


def test_one_narrow_pass(spark):
    env = envelope_df(spark, [{"payload": air()}])
    plan = rejects.classify(env, FEEDS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    assert plan.count("from_json(") <= 2 * len(FEEDS)


@pytest.mark.parametrize("n", [0, 1])
def test_no_rows(spark, n):
    env = envelope_df(spark, [{"payload": air()}]).limit(n)
    assert rejects.split(env, FEEDS)[1].count() == 0
    assert rejects.counts(rejects.classify(env, FEEDS)).count() == 2 * n


def test_a_filter_on_reasons_parses_each_body_once(spark):
    env = envelope_df(spark, [{"payload": air()}])
    for part in rejects.split(env, FEEDS):
        plan = part._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") <= 2 * len(FEEDS)


def test_notes_are_counted_in_the_same_pass(spark):
    env = envelope_df(spark, [{"payload": air('{"aqi":3}')}, {"payload": air('{"aqi":"-"}')}, {"payload": "[1]"}])
    found = rejects.counts(rejects.classify(env, FEEDS), noted=True)
    assert dict(found.collect()) == {"accepted": 2, "accepted, bad_field": 1, "bad_json": 1, "raw": 3}
