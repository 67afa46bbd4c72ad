"""Dimension: candidates (A-only, B-only, both, coalesce), insert-only
upsert with ids, fill-null, stable ids, lookup by country."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from obslake import schemas, specs
from obslake.functions import names
from obslake.operators import dedupe, dims, facts, lookup, parse, registry

from helpers import air, envelope_df

A, B = specs.AIR_QUALITY, specs.WEATHER
DIM = "place_id long, name string, country string, latitude double, longitude double, " \
      "air_name string, weather_name string"


def _feeds(spark):
    a = envelope_df(spark, [
        {"request_id": 1, "place_name": " paris", "payload": air('{"city":{"geo":[48.8,2.3],"name":"Paris A"}}')},
        {"request_id": 0, "place_name": "PARIS", "payload": air('{"city":{"geo":[1.0,1.0],"name":"Paris first"}}')},
        {"request_id": 2, "place_name": "lyon", "payload": air('{"city":{"geo":[45.7],"name":"Lyon A"}}')},
    ])
    b = envelope_df(spark, [
        {"request_id": 3, "feed": "weather", "place_name": "Lyon",
         "payload": '{"cod":200,"coord":{"lat":9.0,"lon":4.8},"name":"Lyon B"}'},
        {"request_id": 4, "feed": "weather", "place_name": "Nice",
         "payload": '{"cod":200,"coord":{"lat":43.7,"lon":7.2},"name":"Nice B"}'},
    ])
    return [(parse.parse_feed(a, A), A), (parse.parse_feed(b, B), B)]


def test_candidates_full_join_and_coalesce(spark):
    got = {r.name: r for r in dims.place_candidates(_feeds(spark)).collect()}
    assert set(got) == {"Paris", "Lyon", "Nice"}
    assert (got["Paris"].latitude, got["Paris"].air_name) == (1.0, "Paris first")  # first request
    assert got["Paris"].weather_name is None                                        # A only
    assert (got["Lyon"].latitude, got["Lyon"].longitude) == (45.7, 4.8)            # A before B
    assert (got["Nice"].air_name, got["Nice"].latitude) == (None, 43.7)             # B only


def test_upsert_insert_only_with_ids(spark):
    existing = spark.createDataFrame([(7, "Paris", "FR", None, None, None, None)], DIM)
    cands = dims.place_candidates(_feeds(spark))
    up = {r.name: r for r in dims.upsert_places(existing, cands).collect()}
    assert up["Paris"].place_id == 7 and up["Paris"].latitude is None  # untouched
    assert up["Lyon"].place_id == int(hashlib.md5(b"Lyon\x1fFR").hexdigest()[:15], 16)
    filled = {r.name: r for r in dims.fill_null_details(existing, cands).collect()}
    assert filled["Paris"].latitude == 1.0 and filled["Paris"].place_id == 7
    # a second run adds nothing
    again = dims.new_places(cands, dims.upsert_places(existing, cands))
    assert again.count() == 0


def test_ids_do_not_depend_on_the_other_places(spark):
    empty = spark.createDataFrame([], DIM)
    cands = dims.place_candidates(_feeds(spark))
    alone = dims.upsert_places(empty, cands.where("name = 'Nice'")).collect()
    together = {r.name: r.place_id for r in dims.upsert_places(empty, cands).collect()}
    assert [(r.name, r.place_id) for r in alone] == [("Nice", together["Nice"])]
    assert len(set(together.values())) == 3 and all(0 <= i < 2**60 for i in together.values())


def test_a_taken_id_gives_the_new_place_a_later_choice(spark):
    digest = hashlib.md5(b"Lyon\x1fFR").hexdigest()
    taken = int(digest[:15], 16)
    existing = spark.createDataFrame([(taken, "Paris", "FR", None, None, None, None)], DIM)
    cands = dims.place_candidates(_feeds(spark))
    up = {r.name: r.place_id for r in dims.upsert_places(existing, cands).collect()}
    assert up["Paris"] == taken and up["Lyon"] == (1 << 60) + int(digest[15:30], 16)
    # stored, the choice holds: also where the other place is gone
    known = registry.decisions(dims.upsert_places(existing, cands), spark.createDataFrame([], schemas.REGISTRY))
    alone = dims.merge_places(spark.createDataFrame([], DIM), cands, registry=known)
    assert {r.name: r.place_id for r in alone.collect()} == up


def test_two_stored_places_with_one_id_fail(spark):
    existing = spark.createDataFrame([(7, "Paris", "FR", None, None, None, None),
                                      (7, "Lyon", "FR", None, None, None, None)], DIM)
    with pytest.raises(Exception, match="two places have id 7"):
        dims.upsert_places(existing, dims.place_candidates(_feeds(spark))).collect()


def test_request_countries_make_places_of_their_own(spark):
    rows = [{"request_id": i, "place_name": "Paris", "country": c, "payload": air(f'{{"aqi":{i}}}')}
            for i, c in enumerate(["FR", "US", None])]
    parsed = parse.parse_feed(envelope_df(spark, rows), A)
    up = dims.upsert_places(spark.createDataFrame([], DIM), dims.place_candidates([(parsed, A)]))
    assert sorted(r.country for r in up.collect()) == ["FR", "US"]
    fact = facts.current_fact(parsed, up, specs.AIR_QUALITY_CURRENT)
    assert sorted(r.aqi for r in fact.collect()) == [0, 1]  # the one without a country is French


def test_lookup_keeps_countries_apart(spark):
    dim = spark.createDataFrame([(1, "Paris", "FR", None, None, None, None),
                                 (2, "Paris", "US", None, None, None, None)], DIM)
    rows = spark.createDataFrame([("PARIS", "FR", 10), ("PARIS", "US", 11), ("LYON", "FR", 12)],
                                 "place_key string, country string, v int")
    got = sorted((r.v, r.place_id) for r in lookup.attach_place(rows, dim).collect())
    assert got == [(10, 1), (11, 2)]


def test_lookup_joins_once_where_names_share_a_key(spark):
    dim = spark.createDataFrame([(4, "Straße", "DE", None, None, None, None),
                                 (3, "Strasse", "DE", None, None, None, None)], DIM)
    key = dim.select(names.lookup_key(F.col("name")).alias("k")).distinct().collect()
    assert len(key) == 1
    rows = spark.createDataFrame([(key[0].k, "DE", 10)], "place_key string, country string, v int")
    assert [r.place_id for r in lookup.attach_place(rows, dim).collect()] == [3]


def test_lookup_and_upsert_plans_have_no_probe(spark):
    """No size probe, no single task: neither a limit nor one partition."""
    parsed = _feeds(spark)
    dim = spark.createDataFrame([(1, "Paris", "FR", None, None, None, None)], DIM)
    for df in (facts.current_fact(parsed[0][0], dim, specs.AIR_QUALITY_CURRENT),
               dims.upsert_places(dim, dims.place_candidates(parsed))):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Limit" not in plan and "SinglePartition" not in plan


def test_dedupe_without_an_order(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, None, "b"), (2, 5, "c")], "k int, o int, v string")
    got = {(r.k, r.v) for r in dedupe.dedupe(df, ["k"], "o").collect()}
    assert got == {(1, "a"), (2, "c")}


def test_forecast_day_listed_twice(spark):
    day = '{"day":"2024-02-01","min":%d,"avg":2,"max":3}'
    payload = air('{"forecast":{"daily":{"o3":[%s,%s]}}}' % (day % 7, day % 1))
    parsed = parse.parse_feed(envelope_df(spark, [{"payload": payload}]), A)
    dim = spark.createDataFrame([(1, "Paris", "FR", None, None, None, None)], DIM)
    (r,) = facts.forecast_fact(parsed, dim, specs.AIR_QUALITY_FORECAST).collect()
    assert r.value_min == 7
