"""Place registry: what a lookup key means is decided once."""

from __future__ import annotations

import hashlib

import pytest

from obslake import schemas
from obslake.operators import registry
from obslake.plans import silver

from helpers import air, envelope_df

STRASSE, SZ = "Strasse", "Straße"


def pid(name: str) -> int:
    return int(hashlib.md5(f"{name}\x1fFR".encode()).hexdigest()[:15], 16)


def rows(name: str, hours, first: int = 0):
    return [{"request_id": first + h, "place_name": name, "fetched_at_utc": f"2024-03-01T{h:02d}:00:00.000Z",
             "payload": air(f'{{"aqi":{h}}}')} for h in hours]


def facts_of(spark, base):
    return sorted((r.place_id, r.fetched_at.hour) for r in spark.read.parquet(f"{base}/air_quality_current").collect())


def names_of(spark, path):
    return {r.name: r.place_id for r in spark.read.parquet(path).collect()}


@pytest.mark.parametrize("early,late", [(STRASSE, SZ), (SZ, STRASSE)])
def test_a_later_spelling_in_a_rerun_stores_nothing_twice(spark, scratch, early, late):
    base = scratch("alias")
    spark.createDataFrame([], schemas.DIMENSION).write.parquet(f"{base}/v0")

    def load(env):
        return silver.load(spark, envelope_df(spark, env), f"{base}/v0", f"{base}/v1", base)

    assert load(rows(early, range(16)))["air_quality_current"] == 16
    # the same rows and, from the same version, the other spelling
    done = load(rows(early, range(16)) + rows(late, range(10, 24), 100))
    assert done["air_quality_current"] == 8 and done["dropped.air_quality"] == 0
    assert facts_of(spark, base) == [(pid(early), h) for h in range(24)]
    assert names_of(spark, f"{base}/v1") == {early: pid(early), late: pid(late)}
    # a rerun in which only the other spelling answers: the place that the
    # facts are stored under is still in the dimension
    assert load(rows(late, range(24), 100))["air_quality_current"] == 0
    assert names_of(spark, f"{base}/v1") == {early: pid(early), late: pid(late)}
    kept = {r.name: r.canonical_id for r in registry.read(spark, base).collect()}
    assert kept == {early: pid(early), late: pid(early)}


def test_keys_that_come_together_take_the_smallest_id(spark, scratch):
    base = scratch("alias")
    dim = spark.createDataFrame([(5, STRASSE, "FR"), (4, SZ, "FR"), (3, STRASSE, "DE"), (2, None, "FR"), (1, "X", None)],
                                "place_id long, name string, country string")
    got = {(r.place_key, r.country): r.place_id for r in registry.lookup(registry.update(spark, base, dim)).collect()}
    assert got == {("STRASSE", "FR"): 4, ("STRASSE", "DE"): 3}
    # nothing new: nothing is appended, also for rows without a key
    before = registry.read(spark, base).inputFiles()
    assert registry.update(spark, base, dim).count() == 3
    assert registry.read(spark, base).inputFiles() == before


def test_a_partly_written_append_is_completed(spark, scratch):
    base = scratch("alias")
    dim = spark.createDataFrame([(5, STRASSE, "FR"), (4, SZ, "FR")], "place_id long, name string, country string")
    lost = registry.decisions(dim, registry.read(spark, base)).where(f"name = '{SZ}'")
    lost.write.parquet(f"{base}/{registry.NAME}")
    assert {r.name: r.canonical_id for r in registry.update(spark, base, dim).collect()} == {STRASSE: 4, SZ: 4}
