"""Raw job end to end with an injected fetcher, then the silver job on the
landed hour; JDBC option assembly (no database is started here)."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from obslake.plans import raw_hour, silver
from obslake.sources import jdbc, raw


def fake_fetch(url: str):
    if "Nimes" in url:
        return 500, ""
    if "Dijon" in url:
        raise ConnectionError("timeout")
    place = url.split("/feed/")[1].split("/")[0] if "/feed/" in url else url.split("q=")[1].split("%2C")[0]
    place = place.replace("%20", " ")
    if "waqi" in url:
        return 200, json.dumps({"status": "ok", "data": {
            "aqi": 42, "city": {"geo": [45.0, 5.0], "name": place + " station"},
            "iaqi": {"pm25": {"v": 12.5}}, "time": {"iso": "2024-06-01T11:00:00+02:00", "v": 1},
            "forecast": {"daily": {"o3": [{"avg": 2.0, "day": "2024-06-02", "max": 3.0, "min": 1.0}]}}}})
    return 200, json.dumps({"cod": 200, "name": place, "dt": 1717232400,
                            "coord": {"lat": 45.1, "lon": 5.1}, "main": {"temp": 21.5},
                            "weather": [{"id": 800, "main": "Clear"}]})


def test_raw_then_silver(spark, scratch):
    places = spark.createDataFrame([(p,) for p in ("Lyon", "Le Havre", "Nimes", "Dijon")],
                                   "place_name string")
    root = scratch("raw")
    raw_hour.run(spark, places, {"air_quality": "TOKEN1", "weather": "TOKEN2"}, root,
                 fake_fetch, "2024-06-01T09:00:12.345Z", parallelism=3)
    landed = raw.read_raw(spark, root, dt="2024-06-01", hour="09")
    rows = landed.collect()
    assert len(rows) == 8
    assert all("TOKEN" not in r.url for r in rows)
    errors = sorted((r.place_name, r.error) for r in rows if not r.ok)
    assert errors == [("Dijon", "ERROR: timeout")] * 2 + [("Nimes", "HTTP_500")] * 2
    assert {r.fetched_at_utc for r in rows} == {"2024-06-01T09:00:12.345Z"}

    base = scratch("silver")
    spark.createDataFrame([], "place_id long, name string, country string, latitude double, "
                              "longitude double, air_name string, weather_name string") \
        .write.parquet(f"{base}/dimension/v0")
    out = silver.run(spark, root, f"{base}/dimension/v0", f"{base}/dimension/v1", base,
                     dt="2024-06-01", hour="09")
    facts = ("air_quality_current", "weather_current", "air_quality_forecast")
    assert out == {"dimension": 2, "candidates": 2, **{f: 2 for f in facts}, **{f"calculated.{f}": 2 for f in facts},
                   "raw_rows.air_quality": 4, "raw_rows.weather": 4, "raw_rows.unrouted": 0,
                   "dropped.air_quality": 0, "dropped.weather": 0}
    dim = {r.name: r for r in spark.read.parquet(f"{base}/dimension/v1").collect()}
    assert set(dim) == {"Le Havre", "Lyon"}
    assert dim["Lyon"].air_name == "Lyon station" and dim["Lyon"].latitude == 45.0
    aq = spark.read.parquet(f"{base}/air_quality_current").where(F.col("pm25") == 12.5)
    assert {str(r.measured_at) for r in aq.collect()} == {"2024-06-01 09:00:00"}
    # landing the same hour again replaces it; silver again inserts nothing
    raw_hour.run(spark, places, {"air_quality": "TOKEN1", "weather": "TOKEN2"}, root,
                 fake_fetch, "2024-06-01T09:00:12.345Z")
    assert raw.read_raw(spark, root).count() == 8
    again = silver.run(spark, root, f"{base}/dimension/v1", f"{base}/dimension/v2", base,
                       dt="2024-06-01", hour="09")
    assert [again[k] for k in ("dimension", *facts)] == [0] * 4


def test_jdbc_options():
    opts = jdbc.reader_options("jdbc:postgresql://db/x", "silver.dim", {"user": "u"},
                               partition_column="place_id", lower=1, upper=1000, num_partitions=8)
    assert opts["partitionColumn"] == "place_id" and opts["numPartitions"] == "8"
    assert opts["dbtable"] == "silver.dim" and opts["user"] == "u"
    w = jdbc.writer_options("jdbc:postgresql://db/x", "silver.f", {}, batch_size=500,
                            column_types="name VARCHAR(128)")
    assert w["batchsize"] == "500" and w["createTableColumnTypes"] == "name VARCHAR(128)"
    import pytest
    with pytest.raises(ValueError):
        jdbc.reader_options("u", "t", {}, partition_column="id")


def test_per_feed_roots_and_legacy_layout(spark, scratch):
    from obslake import specs
    from obslake.plans import silver as silver_job
    places = spark.createDataFrame([("Lyon",), ("Le Havre",)], "place_name string")
    roots = {"air_quality": scratch("raw-aq"), "weather": scratch("raw-wx")}
    raw_hour.run(spark, places, {"air_quality": "T", "weather": "T"}, roots,
                 fake_fetch, "2024-06-01T09:00:00.000Z")
    assert {r.feed for r in raw.read_raw(spark, roots["weather"]).collect()} == {"weather"}
    envs = silver_job.feed_envelopes(spark, roots, (specs.AIR_QUALITY, specs.WEATHER))
    assert envs["air_quality"].count() == 2 and envs["weather"].count() == 2

    # the older layout: city_name, bigint status, offset stamps, no ids
    legacy_root = scratch("legacy")
    lines = [json.dumps({"city_name": "Lyon", "url": "https://api.waqi.info/feed/Lyon/?token=abc",
                         "http_status": 200, "ok": True,
                         "fetched_at_utc": "2024-06-01T11:00:00.000+02:00",
                         "payload": fake_fetch("https://api.waqi.info/feed/Lyon/?token=abc")[1]}),
             json.dumps({"city_name": "Lyon", "url": "https://api.openweathermap.org/x?q=Lyon%2Cfr&appid=k",
                         "http_status": 500, "ok": False,
                         "fetched_at_utc": "2024-06-01T11:00:00.000+02:00", "payload": ""})]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.text(f"{legacy_root}/dt=2024-06-01/hour=11")
    envs = silver_job.feed_envelopes(spark, legacy_root, (specs.AIR_QUALITY, specs.WEATHER),
                                     dt="2024-06-01", hour="11", legacy=True)
    (a,) = envs["air_quality"].collect()
    assert a.place_name == "Lyon" and "abc" not in a.url and a.ok
    (w,) = envs["weather"].collect()
    assert w.error == "HTTP_500"
    from obslake.operators import parse
    (p,) = parse.parse_feed(envs["air_quality"], specs.AIR_QUALITY).collect()
    assert str(p.fetched_at) == "2024-06-01 09:00:00"


def test_run_log_feeds_the_alert(spark, scratch):
    from obslake.plans import runlog
    import datetime as dt
    import pytest
    path = scratch("runlog")
    runlog.logged(spark, path, "silver", lambda: 1)
    with pytest.raises(ZeroDivisionError):
        runlog.logged(spark, path, "silver", lambda: 1 / 0)
    long = "x" * 3_000 + " https://h/?appid=S3CRET&q=1"

    def fails():
        raise ValueError(long)

    with pytest.raises(ValueError):
        runlog.logged(spark, path, "other", fails)
    (detail,) = [r.detail for r in runlog.read(spark, path).where("task = 'other'").collect()]
    assert detail == "ValueError: " + long.replace("S3CRET", "***")
    t = dt.datetime(2024, 1, 1, 10, 0)
    runlog.record(spark, path, "raw", "failed", t, t + dt.timedelta(seconds=30))
    runlog.record(spark, path, "raw", "failed", t, t + dt.timedelta(minutes=2))
    events = runlog.read(spark, path)
    assert events.groupBy("status").count().collect() and events.count() == 5
    fired = runlog.task_failure_alert(spark, path, "raw").where("firing").collect()
    assert fired and all(r.window_start >= dt.datetime(2024, 1, 1, 9, 56) for r in fired)


def test_scheduled_hour_raw_then_silver(spark, scratch):
    from obslake.plans import hourly
    assert hourly.landed_hour("2024-10-27T02:30:00+01:00") == ("2024-10-27", "01")
    assert hourly.landed_hour("2024-06-01T00:10:00.123Z") == ("2024-06-01", "00")
    places = spark.createDataFrame([(p,) for p in ("Lyon", "Le Havre", "Nimes")], "place_name string")
    tokens = {"air_quality": "T1", "weather": "T2"}
    raw_root, base = scratch("raw"), scratch("silver")
    spark.createDataFrame([], "place_id long, name string, country string, latitude double, "
                              "longitude double, air_name string, weather_name string") \
        .write.parquet(f"{base}/dimension/v0")
    stamp = "2024-06-01T11:00:12.345+02:00"
    first = hourly.run(spark, stamp, places, tokens, fake_fetch, raw_root,
                       f"{base}/dimension/v0", f"{base}/dimension/v1", base, parallelism=2)
    assert first["raw_rows.air_quality"] == 3 and first["air_quality_current"] == 2
    assert raw.read_raw(spark, raw_root, dt="2024-06-01", hour="09").count() == 6
    again = hourly.run(spark, stamp, places, tokens, fake_fetch, raw_root,
                       f"{base}/dimension/v1", f"{base}/dimension/v2", base)
    assert again["dimension"] == again["air_quality_current"] == again["weather_current"] == 0
    assert raw.read_raw(spark, raw_root).count() == 6


def test_wide_writes_use_small_methods(spark, monkeypatch, tmp_path):
    from obslake.plans import catalog
    from obslake.sources import raw, tables

    key = "spark.sql.codegen.hugeMethodLimit"
    before, seen = spark.conf.get(key), []
    rows = spark.sql("SELECT 1L request_id, 'f' feed, 'p' place_name, 'u' url, 200 http_status, '{}' body, "
                     "TIMESTAMP_NTZ'2024-01-01 00:00:00' fetched_at")
    keys = raw.with_partition_keys
    monkeypatch.setattr(tables, "COMPILED_BYTES", 4000)
    compiled = tables.compiled
    monkeypatch.setattr(tables, "compiled", lambda s: seen.append(s) or compiled(s))
    raw.land(raw.envelope(rows), str(tmp_path / "raw"), fmt="parquet", partition_by=("dt",))
    assert seen and keys(raw.envelope(rows)).count() == 1
    with compiled(spark):
        assert spark.conf.get(key) == "4000"
    assert spark.conf.get(key) == before

    spark.sql("SELECT id event_id, TIMESTAMP_NTZ'2024-01-01 00:00:00' ts, id user_id, 'view' event_type, 1D value, "
              "'{\"k\": 1}' props FROM range(9)").write.parquet(str(tmp_path / "events.parquet"))
    spark.sql("SELECT INT(id) n_nationkey, 'N' n_name, 0 n_regionkey FROM range(25)").write.parquet(
        str(tmp_path / "nation.parquet"))
    plan = catalog._by_hour(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan
