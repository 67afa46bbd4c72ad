"""Declarative feed, fact and dimension specs.

A new feed is a new :class:`FeedSpec`; no operator changes.  Field maps are
``output column -> payload path`` (see :func:`obslake.functions.paths.at`).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from obslake import schemas
from obslake.functions import time as tf
from obslake.functions.paths import at

# Parsed-feed columns every operator relies on (see operators.parse).
PAYLOAD = "p"


@dataclass(frozen=True)
class FeedSpec:
    """One API feed: how to parse, validate and time-stamp its payload."""

    name: str
    payload_schema: str  # DDL
    valid: Callable[[Column], Column]
    # (parsed payload, fetched_at) -> measured_at (UTC wall clock)
    event_time: Callable[[Column, Column], Column]
    url_template: str
    url_marker: str
    country: str = "FR"
    # dimension details this feed offers: api place name and coordinates
    api_name: str = ""
    latitude: str = ""
    longitude: str = ""
    dimension_name_column: str = ""


@dataclass(frozen=True)
class FactSpec:
    """A current-conditions fact: field map, business key, dedupe order."""

    name: str
    feed: FeedSpec
    fields: Mapping[str, str]
    keys: tuple[str, ...] = ("place_id", "fetched_at")
    lead: tuple[str, ...] = ("place_id", "measured_at", "fetched_at")

    @property
    def columns(self) -> list[str]:
        return list(self.lead) + list(self.fields)


@dataclass(frozen=True)
class ForecastSpec:
    """Wide forecast arrays (one per pollutant) to long rows."""

    name: str
    feed: FeedSpec
    daily_path: str
    pollutants: tuple[str, ...]
    keys: tuple[str, ...] = ("place_id", "pollutant", "forecast_date", "fetched_at")
    columns: tuple[str, ...] = (
        "place_id", "forecast_date", "pollutant",
        "value_min", "value_avg", "value_max", "fetched_at",
    )


def _air_event_time(p: Column, fetched_at: Column) -> Column:
    # Station time when it parses, else the fetch time.  (An unparsable
    # station time falls back too, instead of dropping the row.)
    return F.coalesce(tf.parse_instant(at(p, "data.time.iso")), fetched_at)


def _weather_event_time(p: Column, fetched_at: Column) -> Column:
    # Epoch seconds are already an instant: no local-time string.
    return tf.epoch_seconds_to_utc(at(p, "dt"))


# The two public endpoints the hourly feeds call, with the
# place percent-encoded into the path / query and the secret as parameter.
AIR_URL = "https://api.waqi.info/feed/{place}/?token={token}"
WEATHER_URL = ("https://api.openweathermap.org/data/2.5/weather?q={place}"
               "&appid={token}&units=metric&lang=fr")

AIR_QUALITY = FeedSpec(
    name="air_quality",
    payload_schema=schemas.AIR_QUALITY,
    valid=lambda p: at(p, "status") == F.lit("ok"),
    event_time=_air_event_time,
    url_template=AIR_URL,
    url_marker="waqi.info",
    api_name="data.city.name",
    latitude="data.city.geo[0]",
    longitude="data.city.geo[1]",
    dimension_name_column="air_name",
)

WEATHER = FeedSpec(
    name="weather",
    payload_schema=schemas.WEATHER,
    valid=lambda p: at(p, "cod") == F.lit(200),
    event_time=_weather_event_time,
    url_template=WEATHER_URL,
    url_marker="openweathermap.org",
    api_name="name",
    latitude="coord.lat",
    longitude="coord.lon",
    dimension_name_column="weather_name",
)

# Which payload field each fact column comes from.
AIR_QUALITY_CURRENT = FactSpec(
    name="air_quality_current",
    feed=AIR_QUALITY,
    fields={
        "aqi": "data.aqi",
        "dominant_pollutant": "data.dominentpol",
        "co": "data.iaqi.co.v",
        "no2": "data.iaqi.no2.v",
        "o3": "data.iaqi.o3.v",
        "so2": "data.iaqi.so2.v",
        "pm10": "data.iaqi.pm10.v",
        "pm25": "data.iaqi.pm25.v",
        "humidity": "data.iaqi.h.v",
        "temperature": "data.iaqi.t.v",
        "pressure": "data.iaqi.p.v",
        "wind_speed": "data.iaqi.w.v",
        "epoch_value": "data.time.v",
    },
)

# Which payload field each fact column comes from.
WEATHER_CURRENT = FactSpec(
    name="weather_current",
    feed=WEATHER,
    fields={
        "temperature": "main.temp",
        "feels_like": "main.feels_like",
        "temp_min": "main.temp_min",
        "temp_max": "main.temp_max",
        "pressure": "main.pressure",
        "sea_level_pressure": "main.sea_level",
        "ground_level_pressure": "main.grnd_level",
        "humidity": "main.humidity",
        "wind_speed": "wind.speed",
        "wind_deg": "wind.deg",
        "wind_gust": "wind.gust",
        "cloud_cover": "clouds.all",
        "weather_code": "weather[0].id",
        "weather_main": "weather[0].main",
        "weather_description": "weather[0].description",
        "weather_icon": "weather[0].icon",
        "timezone_offset_s": "timezone",
        "station_id": "id",
        "station_name": "name",
    },
)

AIR_QUALITY_FORECAST = ForecastSpec(
    name="air_quality_forecast",
    feed=AIR_QUALITY,
    daily_path="data.forecast.daily",
    pollutants=("o3", "pm10", "pm25", "uvi"),
)
