"""Feeds derived deterministically from the driver's tables.

The driver tables hold no air or weather data, so API responses are derived
from ``events`` (one response per event) and ``nation`` (the places).  The
rules are plain column arithmetic, so an SQL engine can recompute every
expected fact straight from the base tables without any JSON.

Fixed values (the derivation rules), with ``k`` = integer ``$.k`` of
``events.props``, ``nk = user_id % 25`` the nation key, ``ts`` the event time
read as UTC:

* place: null when ``user_id % 30 = 29``; ``'  ' || lower(n_name) || ' '``
  when user_id is odd; else ``n_name``
* feed: air_quality when event_id is even, weather when odd
* http status: error events give 0 when ``event_id % 3 = 0`` else 500; all
  other events 200.  Body: ``ERROR: timeout`` for 0, empty for 500.
* fetch time: ``ts`` truncated to the hour
* air quality: status ``error`` for signup events else ``ok``; aqi the
  string ``-`` when ``k % 10 = 0`` else k; geo ``[nk]`` when ``k % 13 = 0``
  else ``[nk, 10 nk]``; dominant pollutant pm25 for even k else o3;
  iaqi co k/10, no2 1.5k, o3 k+0.5, so2 absent when ``k % 4 = 0`` else k/4,
  pm10 2k, pm25 value, h k, t value/2, p 1000+k, w k/20;
  time.v epoch seconds of ts; time.iso absent when ``k % 7 = 0``, ``bad``
  when ``k % 7 = 1``, else ts in ISO with milliseconds and Z;
  forecast absent when ``k % 5 = 0``; else o3 = two days (day+1: min k,
  avg k+1, max k+2; day+2: 1, 2, 3), pm10 = [], pm25 absent, uvi = one day
  (day+3, or ``n/a`` when ``k % 5 = 1``; min 0, avg k/10, max k/5)
* weather: coord lat 2 nk, lon 3 nk; weather = [] when ``k % 6 = 0`` else
  one entry (id k, main event_type, description ``event <type>``, icon
  ``<k % 10>d``); main temp value, feels_like value-1, temp_min value-2,
  temp_max value+2, pressure 1000+k, humidity k, sea_level 1010+k,
  grnd_level 990+k; visibility 10000; wind speed k/4, deg ``7k % 360``,
  gust absent when ``k % 3 = 0`` else k/2; clouds k; dt epoch seconds of ts;
  sys (FR, dt-3600, dt+3600); timezone 3600; id 1000+nk; name n_name;
  cod the string ``"404"`` for signup events else 200
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake import specs
from obslake.functions import time as tf
from obslake.functions.urls import fill_template, percent_encode

FAKE_TOKEN = "s3cr3t"

# Answers of the stand-in HTTP client, a function of the
# customer number n in the requested URL (``Customer%23<n>``):
# network error, whose text quotes the URL, when n % 17 = 0; status 500 with an empty body
# when n % 11 = 0; weather answers 404 with CITY_NOT_FOUND when n % 5 = 0;
# otherwise 200 with AIR_OK (aqi = n % 300) or WEATHER_OK (id = n).
CITY_NOT_FOUND = '{"cod":"404","message":"city not found"}'
AIR_OK = '{{"status":"ok","data":{{"aqi":{aqi}}}}}'
WEATHER_OK = '{{"cod":200,"id":{id}}}'
_CUSTOMER_IN_URL = re.compile(r"Customer%23(\d+)")


def stand_in_fetch(url: str) -> tuple[int, str]:
    """Stand-in for the HTTP client of the raw job (see the fixed values
    above); raises like a client whose request timed out."""
    n = int(_CUSTOMER_IN_URL.search(url).group(1))
    if n % 17 == 0:
        raise TimeoutError(f"timeout {url}")
    if n % 11 == 0:
        return 500, ""
    if specs.WEATHER.url_marker in url:
        return (404, CITY_NOT_FOUND) if n % 5 == 0 else (200, WEATHER_OK.format(id=n))
    return 200, AIR_OK.format(aqi=n % 300)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _num(c: Column) -> Column:
    return c.cast("string")


def _json_str(c: Column) -> Column:
    return F.concat(F.lit('"'), c, F.lit('"'))


def _base(events: DataFrame, nation: DataFrame) -> DataFrame:
    nat = nation.select("n_nationkey", "n_name")
    e = events.select(
        "event_id", "ts", "user_id", "event_type", "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.col("user_id") % 25).cast("int").alias("nk"),
    )
    return e.join(nat, e.nk == nat.n_nationkey, "inner").drop("n_nationkey")


def _air_payload() -> Column:
    k, nk, v, ts = F.col("k"), F.col("nk"), F.col("value"), F.col("ts")
    epoch = tf.utc_epoch_seconds(ts)
    day = F.to_date(ts)
    geo = F.when(k % 13 == 0, F.array(nk.cast("double"))) \
           .otherwise(F.array(nk.cast("double"), (nk * 10).cast("double")))
    city = F.to_json(F.struct(geo.alias("geo"), F.col("n_name").alias("name"),
                              F.lit("https://example.org/place").alias("url")))
    iaqi = F.to_json(F.struct(
        F.struct((k / 10).alias("v")).alias("co"),
        F.struct((k * 1.5).alias("v")).alias("no2"),
        F.struct((k + 0.5).alias("v")).alias("o3"),
        F.when(k % 4 != 0, F.struct((k / 4).alias("v"))).alias("so2"),
        F.struct((k * 2).cast("double").alias("v")).alias("pm10"),
        F.struct(v.alias("v")).alias("pm25"),
        F.struct(k.cast("double").alias("v")).alias("h"),
        F.struct((v / 2).alias("v")).alias("t"),
        F.struct((k + 1000).cast("double").alias("v")).alias("p"),
        F.struct((k / 20).alias("v")).alias("w"),
    ))
    iso = F.when(k % 7 == 0, F.lit(None).cast("string")) \
           .when(k % 7 == 1, F.lit("bad")) \
           .otherwise(tf.format_utc_iso(ts))
    time = F.to_json(F.struct(
        F.substring(ts.cast("string"), 1, 19).alias("s"), F.lit("+00:00").alias("tz"),
        epoch.alias("v"), iso.alias("iso")))

    def fday(d, lo, avg, hi):
        return F.struct(avg.cast("double").alias("avg"), d.alias("day"),
                        hi.cast("double").alias("max"), lo.cast("double").alias("min"))
    o3 = F.array(fday(F.date_add(day, 1).cast("string"), k, k + 1, k + 2),
                 fday(F.date_add(day, 2).cast("string"), F.lit(1), F.lit(2), F.lit(3)))
    uvi_day = F.when(k % 5 == 1, F.lit("n/a")).otherwise(F.date_add(day, 3).cast("string"))
    uvi = F.array(fday(uvi_day, F.lit(0), k / 10, k / 5))
    empty = F.array().cast("array<struct<avg:double,day:string,max:double,min:double>>")
    forecast = F.to_json(F.struct(F.struct(o3.alias("o3"), empty.alias("pm10"),
                                           uvi.alias("uvi")).alias("daily")))
    aqi = F.when(k % 10 == 0, F.lit('"-"')).otherwise(_num(k))
    status = F.when(F.col("event_type") == "signup", "error").otherwise("ok")
    return F.concat(
        F.lit('{"status":'), _json_str(status),
        F.lit(',"data":{"aqi":'), aqi,
        F.lit(',"idx":'), _num(F.col("user_id")),
        F.lit(',"city":'), city,
        F.lit(',"dominentpol":'), _json_str(F.when(k % 2 == 0, "pm25").otherwise("o3")),
        F.lit(',"iaqi":'), iaqi,
        F.lit(',"time":'), time,
        F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit(',"forecast":'), forecast)),
        F.lit("}}"),
    )


def _weather_payload() -> Column:
    k, nk, v, ts = F.col("k"), F.col("nk"), F.col("value"), F.col("ts")
    epoch = tf.utc_epoch_seconds(ts)
    weather = F.when(k % 6 == 0, F.array().cast(
        "array<struct<id:int,main:string,description:string,icon:string>>")).otherwise(
        F.array(F.struct(k.alias("id"), F.col("event_type").alias("main"),
                         F.concat(F.lit("event "), F.col("event_type")).alias("description"),
                         F.concat((k % 10).cast("string"), F.lit("d")).alias("icon"))))
    body = F.to_json(F.struct(
        F.struct((nk * 3).cast("double").alias("lon"), (nk * 2).cast("double").alias("lat")).alias("coord"),
        weather.alias("weather"),
        F.struct(v.alias("temp"), (v - 1).alias("feels_like"), (v - 2).alias("temp_min"),
                 (v + 2).alias("temp_max"), (k + 1000).alias("pressure"), k.alias("humidity"),
                 (k + 1010).alias("sea_level"), (k + 990).alias("grnd_level")).alias("main"),
        F.lit(10000).alias("visibility"),
        F.struct((k / 4).alias("speed"), ((k * 7) % 360).alias("deg"),
                 F.when(k % 3 != 0, k / 2).alias("gust")).alias("wind"),
        F.struct(k.alias("all")).alias("clouds"),
        epoch.alias("dt"),
        F.struct(F.lit("FR").alias("country"), (epoch - 3600).alias("sunrise"),
                 (epoch + 3600).alias("sunset")).alias("sys"),
        F.lit(3600).alias("timezone"),
        (nk + 1000).cast("long").alias("id"),
        F.col("n_name").alias("name"),
    ))
    cod = F.when(F.col("event_type") == "signup", F.lit('"404"')).otherwise(F.lit("200"))
    # splice the cod field in: its JSON type differs between rows
    return F.concat(F.regexp_replace(body, r"\}$", ""), F.lit(',"cod":'), cod, F.lit("}"))


def responses(events: DataFrame, nation: DataFrame) -> DataFrame:
    """One API response per event: request_id, feed, place_name, url,
    http_status, body, fetched_at (UTC wall clock)."""
    b = _base(events, nation)
    uid, eid = F.col("user_id"), F.col("event_id")
    place = F.when(uid % 30 == 29, F.lit(None).cast("string")) \
             .when(uid % 2 == 1, F.concat(F.lit("  "), F.lower("n_name"), F.lit(" "))) \
             .otherwise(F.col("n_name"))
    feed = F.when(eid % 2 == 0, F.lit(specs.AIR_QUALITY.name)).otherwise(F.lit(specs.WEATHER.name))
    status = F.when(F.col("event_type") == "error",
                    F.when(eid % 3 == 0, F.lit(0)).otherwise(F.lit(500))).otherwise(F.lit(200))
    name = F.coalesce(place, F.lit(""))
    url = F.when(eid % 2 == 0,
                 fill_template(specs.AIR_URL, place=percent_encode(name),
                               token=F.lit(FAKE_TOKEN))) \
           .otherwise(fill_template(specs.WEATHER_URL,
                                    place=percent_encode(F.concat(name, F.lit(",fr"))),
                                    token=F.lit(FAKE_TOKEN)))
    body = F.when(status == 0, F.lit("ERROR: timeout")) \
            .when(status == 500, F.lit("")) \
            .when(eid % 2 == 0, _air_payload()) \
            .otherwise(_weather_payload())
    hour = tf.floor_to(F.col("ts"), "hour")
    return b.select(
        eid.alias("request_id"), feed.alias("feed"), place.alias("place_name"),
        url.alias("url"), status.alias("http_status"), body.alias("body"),
        hour.alias("fetched_at"),
    )


def nation_dimension(nation: DataFrame) -> DataFrame:
    """Place dimension over all nations: id = key + 1, name initcap."""
    nk = F.col("n_nationkey")
    return nation.select(
        (nk + 1).cast("long").alias("place_id"),
        F.initcap(F.col("n_name")).alias("name"),
        F.lit("FR").alias("country"),
        (nk * 2).cast("double").alias("latitude"),
        (nk * 3).cast("double").alias("longitude"),
        F.col("n_name").alias("air_name"),
        F.col("n_name").alias("weather_name"),
    )


def stored_dimension(nation: DataFrame) -> DataFrame:
    """An already-loaded dimension: nations of regions 0-2, id = key + 1,
    latitude unknown when ``key % 3 = 0`` else 5 key, no API names."""
    nk = F.col("n_nationkey")
    return nation.where(F.col("n_regionkey") < 3).select(
        (nk + 1).cast("long").alias("place_id"),
        F.initcap(F.col("n_name")).alias("name"),
        F.lit("FR").alias("country"),
        F.when(nk % 3 != 0, (nk * 5).cast("double")).alias("latitude"),
        F.lit(None).cast("double").alias("longitude"),
        F.lit(None).cast("string").alias("air_name"),
        F.lit(None).cast("string").alias("weather_name"),
    )
