"""Explicit schemas at both ends: raw envelope and API payloads.

Nothing is inferred: an inferred envelope turns ``hour=09`` into ``9`` and
``fetched_at_utc`` into a string of unknown offset, and an empty directory
fails schema inference.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# The raw envelope (one row per API response).  ``request_id``,
# ``feed``, ``error`` and ``country`` (that of the request, null where it had
# none) are ours; the rest is the landed-response contract.
ENVELOPE_DDL = """
request_id BIGINT,
feed STRING,
place_name STRING,
url STRING,
http_status INT,
ok BOOLEAN,
error STRING,
fetched_at_utc STRING,
payload STRING,
country STRING
"""
PARTITION_DDL = "dt DATE, hour STRING"

# The older landed-response layout (one root per feed, place
# column ``city_name``, no ids).  ``http_status`` is read as BIGINT, the
# type a JSON round trip gives it; the fetch stamp is ISO with an offset.
LEGACY_ENVELOPE_DDL = """
city_name STRING,
url STRING,
http_status BIGINT,
ok BOOLEAN,
fetched_at_utc STRING,
payload STRING
"""

# Payload contract of the air-quality feed (feed A), the fields
# that facts and dimension read.
AIR_QUALITY_DDL = """
status STRING,
data STRUCT<
  aqi: INT,
  city: STRUCT<geo: ARRAY<DOUBLE>, name: STRING>,
  dominentpol: STRING,
  iaqi: STRUCT<
    co: STRUCT<v: DOUBLE>, no2: STRUCT<v: DOUBLE>, o3: STRUCT<v: DOUBLE>,
    pm10: STRUCT<v: DOUBLE>, pm25: STRUCT<v: DOUBLE>, so2: STRUCT<v: DOUBLE>,
    h: STRUCT<v: DOUBLE>, t: STRUCT<v: DOUBLE>, p: STRUCT<v: DOUBLE>, w: STRUCT<v: DOUBLE>>,
  time: STRUCT<v: BIGINT, iso: STRING>,
  forecast: STRUCT<daily: STRUCT<
    o3: ARRAY<STRUCT<avg: DOUBLE, day: STRING, max: DOUBLE, min: DOUBLE>>,
    pm10: ARRAY<STRUCT<avg: DOUBLE, day: STRING, max: DOUBLE, min: DOUBLE>>,
    pm25: ARRAY<STRUCT<avg: DOUBLE, day: STRING, max: DOUBLE, min: DOUBLE>>,
    uvi: ARRAY<STRUCT<avg: DOUBLE, day: STRING, max: DOUBLE, min: DOUBLE>>>>>
"""

# Payload contract of the current-weather feed (feed B), the
# fields that facts and dimension read.
WEATHER_DDL = """
coord STRUCT<lon: DOUBLE, lat: DOUBLE>,
weather ARRAY<STRUCT<id: INT, main: STRING, description: STRING, icon: STRING>>,
main STRUCT<temp: DOUBLE, feels_like: DOUBLE, temp_min: DOUBLE, temp_max: DOUBLE,
            pressure: INT, humidity: INT, sea_level: INT, grnd_level: INT>,
wind STRUCT<speed: DOUBLE, deg: INT, gust: DOUBLE>,
clouds STRUCT<all: INT>,
dt BIGINT,
timezone INT,
id BIGINT,
name STRING,
cod INT
"""

# Place dimension contract.  Natural key: (name, country).
DIMENSION_DDL = """
place_id BIGINT,
name STRING,
country STRING,
latitude DOUBLE,
longitude DOUBLE,
air_name STRING,
weather_name STRING
"""

# Place registry contract: the id of a natural key, its lookup form and the
# place that the lookup form stands for.
REGISTRY_DDL = """
place_id BIGINT,
name STRING,
country STRING,
place_key STRING,
canonical_id BIGINT
"""


def ddl(text: str) -> str:
    """One-line DDL (accepted by ``from_json`` and ``DataFrameReader.schema``;
    no session is needed to import this module)."""
    return " ".join(text.split())


def struct_fields(columns: str) -> str:
    """The fields of a struct from the columns of a table (needs a session)."""
    return StructType.fromDDL(columns).simpleString().removeprefix("struct<").removesuffix(">")


ENVELOPE = ddl(ENVELOPE_DDL)
RAW_TABLE = ddl(ENVELOPE_DDL + "," + PARTITION_DDL)
LEGACY_RAW_TABLE = ddl(LEGACY_ENVELOPE_DDL + "," + PARTITION_DDL)
AIR_QUALITY = ddl(AIR_QUALITY_DDL)
WEATHER = ddl(WEATHER_DDL)
DIMENSION = ddl(DIMENSION_DDL)
REGISTRY = ddl(REGISTRY_DDL)

DIMENSION_KEY = ("name", "country")
DIMENSION_DETAILS = ("latitude", "longitude", "air_name", "weather_name")
