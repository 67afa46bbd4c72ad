"""DuckDB SQL computing every registered query straight from the base
tables, with no JSON: the derivation rules of
:mod:`obslake.plans.derived_feed` are applied as column arithmetic, so the
Spark side (JSON text -> parse -> validate -> facts) is really checked.
"""

from __future__ import annotations

INITCAP = ("array_to_string(list_transform(string_split(lower(trim({x})), ' '), "
           "lambda w: upper(left(w, 1)) || w[2:]), ' ')")

# Derived responses: one per event.
BASE = """
WITH b AS (
  SELECT e.event_id, e.ts, e.user_id, e.event_type, e.value,
         CAST(json_extract_string(e.props, '$.k') AS INTEGER) AS k,
         CAST(e.user_id % 25 AS INTEGER) AS nk, n.n_name
  FROM events e JOIN nation n ON n.n_nationkey = e.user_id % 25
),
r AS (
  SELECT *,
    CASE WHEN user_id % 30 = 29 THEN NULL
         WHEN user_id % 2 = 1 THEN '  ' || lower(n_name) || ' '
         ELSE n_name END AS place_raw,
    CASE WHEN event_id % 2 = 0 THEN 'air_quality' ELSE 'weather' END AS feed,
    CASE WHEN event_type = 'error' THEN CASE WHEN event_id % 3 = 0 THEN 0 ELSE 500 END
         ELSE 200 END AS http_status,
    date_trunc('hour', ts) AS fetched_at
  FROM b
),
va AS (  -- valid air-quality rows
  SELECT *, {name} AS place_name,
    CASE WHEN k % 7 IN (0, 1) THEN fetched_at ELSE date_trunc('millisecond', ts) END AS measured_at
  FROM r
  WHERE feed = 'air_quality' AND http_status = 200 AND event_type <> 'signup'
    AND place_raw IS NOT NULL
),
vb AS (  -- valid weather rows
  SELECT *, {name} AS place_name, date_trunc('second', ts) AS measured_at
  FROM r
  WHERE feed = 'weather' AND http_status = 200 AND event_type <> 'signup'
    AND place_raw IS NOT NULL
)
""".replace("{name}", INITCAP.format(x="place_raw"))

# The id of a place: the first 15 hex digits of the md5 of its natural key.
PLACE_ID = "CAST('0x' || md5(name || chr(31) || country)[1:15] AS BIGINT)"

STORED = """,
stored AS (
  SELECT CAST(n_nationkey + 1 AS BIGINT) AS place_id, {initcap_n} AS name, 'FR' AS country,
         CASE WHEN n_nationkey % 3 <> 0 THEN CAST(n_nationkey * 5 AS DOUBLE) END AS latitude,
         CAST(NULL AS DOUBLE) AS longitude, CAST(NULL AS VARCHAR) AS air_name,
         CAST(NULL AS VARCHAR) AS weather_name
  FROM nation WHERE n_regionkey < 3
)
""".replace("{initcap_n}", INITCAP.format(x="n_name"))


def upserted(n: int, before: str, where: str) -> str:
    """CTEs of one upsert into ``before``: candidates per feed among the rows
    of ``where`` (first request wins), full join, coalesce, fresh rows."""
    return f""",
ca{n} AS (
  SELECT place_name AS name, 'FR' AS country,
         arg_min(CAST(nk AS DOUBLE), event_id) AS lat_a,
         arg_min_null(CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(nk * 10 AS DOUBLE) END, event_id) AS lon_a,
         arg_min(n_name, event_id) AS air_name
  FROM va WHERE {where} GROUP BY place_name
),
cb{n} AS (
  SELECT place_name AS name, 'FR' AS country,
         arg_min(CAST(nk * 2 AS DOUBLE), event_id) AS lat_b,
         arg_min(CAST(nk * 3 AS DOUBLE), event_id) AS lon_b,
         arg_min(n_name, event_id) AS weather_name
  FROM vb WHERE {where} GROUP BY place_name
),
cand{n} AS (
  SELECT coalesce(a.name, b.name) AS name, coalesce(a.country, b.country) AS country,
         coalesce(lat_a, lat_b) AS latitude, coalesce(lon_a, lon_b) AS longitude,
         air_name, weather_name
  FROM ca{n} a FULL OUTER JOIN cb{n} b ON a.name = b.name AND a.country = b.country
),
fresh{n} AS (
  SELECT * FROM cand{n} c
  WHERE NOT EXISTS (SELECT 1 FROM {before} s WHERE s.name = c.name AND s.country = c.country)
),
upserted{n} AS (
  SELECT * FROM {before}
  UNION ALL
  SELECT {PLACE_ID} AS place_id, name, country, latitude, longitude, air_name, weather_name FROM fresh{n}
)
"""


CANDIDATES = STORED + upserted(1, "stored", "true")

FACT_A = """
SELECT place_id, measured_at, fetched_at, aqi, dominant_pollutant, co, no2, o3, so2, pm10,
       pm25, humidity, temperature, pressure, wind_speed, epoch_value
FROM (
  SELECT CAST(nk + 1 AS BIGINT) AS place_id, measured_at, fetched_at,
    CASE WHEN k % 10 = 0 THEN NULL ELSE k END AS aqi,
    CASE WHEN k % 2 = 0 THEN 'pm25' ELSE 'o3' END AS dominant_pollutant,
    CAST(k AS DOUBLE) / 10 AS co, CAST(k AS DOUBLE) * 1.5 AS no2, CAST(k AS DOUBLE) + 0.5 AS o3,
    CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(k AS DOUBLE) / 4 END AS so2,
    CAST(k * 2 AS DOUBLE) AS pm10, value AS pm25, CAST(k AS DOUBLE) AS humidity,
    value / 2 AS temperature, CAST(k + 1000 AS DOUBLE) AS pressure,
    CAST(k AS DOUBLE) / 20 AS wind_speed, epoch_us(ts) // 1000000 AS epoch_value,
    row_number() OVER (PARTITION BY nk, fetched_at ORDER BY event_id) AS rn
  FROM va
) WHERE rn = 1
"""

FACT_B = """
SELECT place_id, measured_at, fetched_at, temperature, feels_like, temp_min, temp_max,
       pressure, sea_level_pressure, ground_level_pressure, humidity, wind_speed, wind_deg,
       wind_gust, cloud_cover, weather_code, weather_main, weather_description, weather_icon,
       timezone_offset_s, station_id, station_name
FROM (
  SELECT CAST(nk + 1 AS BIGINT) AS place_id, measured_at, fetched_at,
    value AS temperature, value - 1 AS feels_like, value - 2 AS temp_min, value + 2 AS temp_max,
    k + 1000 AS pressure, k + 1010 AS sea_level_pressure, k + 990 AS ground_level_pressure,
    k AS humidity, CAST(k AS DOUBLE) / 4 AS wind_speed, (k * 7) % 360 AS wind_deg,
    CASE WHEN k % 3 = 0 THEN NULL ELSE CAST(k AS DOUBLE) / 2 END AS wind_gust,
    k AS cloud_cover,
    CASE WHEN k % 6 = 0 THEN NULL ELSE k END AS weather_code,
    CASE WHEN k % 6 = 0 THEN NULL ELSE event_type END AS weather_main,
    CASE WHEN k % 6 = 0 THEN NULL ELSE 'event ' || event_type END AS weather_description,
    CASE WHEN k % 6 = 0 THEN NULL ELSE CAST(k % 10 AS VARCHAR) || 'd' END AS weather_icon,
    3600 AS timezone_offset_s, CAST(1000 + nk AS BIGINT) AS station_id, n_name AS station_name,
    row_number() OVER (PARTITION BY nk, fetched_at ORDER BY event_id) AS rn
  FROM vb
) WHERE rn = 1
"""

FORECAST = """
SELECT place_id, forecast_date, pollutant, value_min, value_avg, value_max, fetched_at
FROM (
  SELECT *, row_number() OVER (PARTITION BY place_id, pollutant, forecast_date, fetched_at
                               ORDER BY event_id) AS rn
  FROM (
    SELECT CAST(nk + 1 AS BIGINT) AS place_id, event_id, fetched_at, 'o3' AS pollutant,
           CAST(ts AS DATE) + 1 AS forecast_date, CAST(k AS DOUBLE) AS value_min,
           CAST(k + 1 AS DOUBLE) AS value_avg, CAST(k + 2 AS DOUBLE) AS value_max
    FROM va WHERE k % 5 <> 0
    UNION ALL
    SELECT CAST(nk + 1 AS BIGINT), event_id, fetched_at, 'o3', CAST(ts AS DATE) + 2,
           1.0, 2.0, 3.0
    FROM va WHERE k % 5 <> 0
    UNION ALL
    SELECT CAST(nk + 1 AS BIGINT), event_id, fetched_at, 'uvi', CAST(ts AS DATE) + 3,
           0.0, CAST(k AS DOUBLE) / 10, CAST(k AS DOUBLE) / 5
    FROM va WHERE k % 5 NOT IN (0, 1)
  )
) WHERE rn = 1
"""

STORED_UNTIL = "TIMESTAMP '2024-01-16 00:00:00'"


def silver_rows(dimension: str, where: str, ids: str = "", order: str = "event_id") -> str:
    """Rows of the three facts among those of ``where`` and of the dimension,
    as one table; places have the id of ``dimension``, or that of ``ids`` (nk,
    place_id), and the row kept of a key is the first by ``order``."""
    facts = {"air_quality_current": FACT_A, "weather_current": FACT_B, "air_quality_forecast": FORECAST}
    named = (f"{ids} u ON u.nk = n.n_nationkey" if ids
             else f"{dimension} u ON u.name = {INITCAP.format(x='n.n_name')}")
    parts = [f"""SELECT '{fact}' AS fact, u.place_id, f.* EXCLUDE (place_id)
FROM ({sql.replace("ORDER BY event_id", f"ORDER BY {order}")}) f JOIN nation n ON f.place_id = n.n_nationkey + 1
JOIN {named} WHERE {where}""" for fact, sql in facts.items()]
    parts.append(f"SELECT 'dimension' AS fact, * FROM {dimension}")
    return " UNION ALL BY NAME ".join(f"({p})" for p in parts)


# The feed with two spellings of each place that share a lookup key.  The
# first one, where a place has it, gives the id and is stored first.
SPELLED_BASE = BASE.replace("""WHEN user_id % 2 = 1 THEN '  ' || lower(n_name) || ' '
         ELSE n_name END AS place_raw""", """ELSE n_name || CASE WHEN event_id % 4 < 2 THEN ' strasse' ELSE ' straße' END END AS place_raw""")
SPELLED_IDS = """,
spelled AS (
  SELECT n.n_nationkey AS nk, arg_min(u.place_id, u.name LIKE '%ß%') AS place_id
  FROM (SELECT name, {id} AS place_id FROM fresh1) u JOIN nation n ON split_part(u.name, ' ', 1) = {name}
  GROUP BY n.n_nationkey
)
""".replace("{name}", INITCAP.format(x="n.n_name")).replace("{id}", PLACE_ID)


def silver_counts() -> str:
    facts = {"air_quality_current": FACT_A, "weather_current": FACT_B, "air_quality_forecast": FORECAST}
    parts = ["SELECT 'raw_rows.' || feed AS metric, count(*) AS value FROM r GROUP BY feed"]
    parts += [f"SELECT '{m}', 0" for m in ("raw_rows.unrouted", "dropped.air_quality", "dropped.weather")]
    parts += ["SELECT 'candidates', count(*) FROM cand1", "SELECT 'dimension', count(*) FROM fresh1"]
    parts += [f"SELECT '{m}', count(*) FROM ({sql})" for f, sql in facts.items() for m in (f, f"calculated.{f}")]
    return " UNION ALL ".join(parts)


FIRST_HOUR = "fetched_at = TIMESTAMP '2024-01-10 09:00:00'"
ALERT = """
WITH f AS (
  SELECT date_trunc('minute', ts) AS m FROM events WHERE event_type = 'error'
),
win AS (
  SELECT m - INTERVAL (o) MINUTE AS s, count(*) AS n FROM f, range(5) t(o) GROUP BY 1
)
SELECT s AS window_start, s + INTERVAL 5 MINUTE AS window_end, n AS n_failed,
       EXISTS (SELECT 1 FROM win p WHERE p.s = win.s - INTERVAL 1 MINUTE) AS firing
FROM win"""
# Every customer in its nation, each seventh in the next one too.
CUSTOMER_PLACES = """customer c JOIN nation n ON n.n_nationkey = c.c_nationkey
       OR (c.c_custkey % 7 = 0 AND n.n_nationkey = (c.c_nationkey + 1) % 25)"""

ENVELOPE = """
SELECT event_id AS request_id, feed, place_raw AS place_name,
  CASE WHEN feed = 'air_quality'
       THEN 'https://api.waqi.info/feed/' || replace(url_encode(coalesce(place_raw, '')), '%2F', '/')
            || '/?token=***'
       ELSE 'https://api.openweathermap.org/data/2.5/weather?q='
            || replace(url_encode(coalesce(place_raw, '') || ',fr'), '%2F', '/')
            || '&appid=***&units=metric&lang=fr' END AS url,
  http_status, http_status = 200 AS ok,
  CASE WHEN http_status = 200 THEN NULL WHEN http_status = 0 THEN 'ERROR: timeout'
       ELSE 'HTTP_' || CAST(http_status AS VARCHAR) END AS error,
  strftime(fetched_at, '%Y-%m-%dT%H:%M:%S.000Z') AS fetched_at_utc, CAST(NULL AS VARCHAR) AS country
FROM r
"""

PARTS = ("fetched_at < DATE '2024-01-11'", "fetched_at >= DATE '2024-01-11' AND fetched_at < DATE '2024-01-21'",
         "fetched_at >= DATE '2024-01-21'")

# Reasons of the damaged lines, in the order of the checks.
REJECTS = """,
damaged AS (
  SELECT *, event_id % 23 = 5 AS cut, event_id % 31 = 7 AS unrouted, event_id % 37 = 11 AS soon,
    http_status = 200 AND event_id % 31 <> 7 AS usable, http_status = 200 AND event_id % 29 = 3 AS half,
    CASE WHEN feed = 'weather' THEN event_id % 41 = 13 ELSE k % 7 IN (0, 1) AND event_id % 37 = 11 END AS no_event
  FROM r
),
reasons AS (
  SELECT event_id, feed, event_type, k, CAST(fetched_at AS DATE) AS dt, usable AND NOT half AS readable,
    CASE WHEN cut THEN ['bad_line'] ELSE list_filter([
      CASE WHEN unrouted THEN 'unrouted' END,
      CASE WHEN http_status = 0 THEN 'no_answer' END,
      CASE WHEN http_status NOT IN (0, 200) THEN 'http_error' END,
      CASE WHEN usable AND half THEN 'bad_json' END,
      CASE WHEN usable AND NOT half AND event_type = 'signup' THEN 'bad_payload' END,
      CASE WHEN place_raw IS NULL THEN 'no_place' END,
      CASE WHEN soon THEN 'no_fetch_time' END,
      CASE WHEN usable AND NOT half AND event_type <> 'signup' AND no_event THEN 'no_event_time' END
    ], lambda x: x IS NOT NULL) END AS reasons
  FROM damaged
)
"""

# Expected hours with what has happened to them.
CATCH_UP = """,
landed AS (SELECT DISTINCT fetched_at FROM r),
expected AS (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31 23:00:00', INTERVAL 1 HOUR)) AS h)
SELECT CAST(h AS DATE) AS dt, strftime(h, '%H') AS hour,
  CASE WHEN fetched_at IS NULL OR (hour(h) = 5 AND day(h) % 2 = 1) THEN 'missing'
       WHEN hour(h) % 2 = 1 THEN 'pending' WHEN day(h) % 5 = 0 THEN 'relanded' ELSE 'done' END AS status
FROM expected LEFT JOIN landed ON h = fetched_at
"""


def catch_up_rows() -> str:
    """The tables after two catch-ups, 384 landed hours at a time: the even
    hours, then the odd ones (but those that never come) and the even ones of
    every fifth day."""
    came = "NOT (hour(fetched_at) = 5 AND day(fetched_at) % 2 = 1)"
    even = "hour(fetched_at) % 2 = 0"
    order = ",".join(f"""
w{n} AS (SELECT fetched_at, (row_number() OVER (ORDER BY fetched_at) - 1) // 384 AS part
         FROM (SELECT DISTINCT fetched_at FROM r WHERE {rows}))"""
                     for n, rows in ((1, even), (2, f"{came} AND (NOT ({even}) OR day(fetched_at) % 5 = 0)")))
    sql, before, n = "," + order + STORED, "stored", 0
    for step, parts in ((1, 1), (2, 2)):
        for part in range(parts):
            n += 1
            sql += upserted(n, before, f"fetched_at IN (SELECT fetched_at FROM w{step} WHERE part = {part})")
            before = f"upserted{n}"
    return sql + silver_rows(before, came)


# Readings and, for each pollutant, the forecast fetched last before them.
IN_FORCE = f"""
SELECT a.place_id, a.measured_at, a.forecast_date, a.pollutant, f.fetched_at AS forecast_at,
       f.value_min, f.value_avg, f.value_max
FROM (SELECT place_id, measured_at, CAST(measured_at AS DATE) AS forecast_date, pollutant
      FROM ({FACT_A}), (VALUES ('o3'), ('uvi')) p(pollutant)) a
ASOF LEFT JOIN ({FORECAST}) f
  ON a.place_id = f.place_id AND a.pollutant = f.pollutant AND a.forecast_date = f.forecast_date
     AND a.measured_at >= f.fetched_at"""

EPISODES = f"""
SELECT min(window_start) AS episode_start, max(window_end) AS episode_end, count(*) AS n_windows,
       max(n_failed) AS most_failed
FROM (SELECT *, count(*) FILTER (window_start > before OR before IS NULL) OVER (ORDER BY window_start) AS episode
      FROM (SELECT *, lag(window_end) OVER (ORDER BY window_start) AS before
            FROM ({ALERT}) WHERE firing))
GROUP BY episode"""

# Every reading with those of the day before it; medians are lower ones.
VARIATIONS = f"""
SELECT place_id, measured_at, pm25, len(before) AS n_before, pm25 - list_max(before).v AS delta, score,
       coalesce(abs(score) > 3.5, false) AS extreme
FROM (
  SELECT *, CASE WHEN len(before) >= 5 AND spread > 0 THEN (pm25 - med) / (1.4826 * spread) END AS score
  FROM (
    SELECT *, list_sort(list_transform(before, lambda b: abs(b.v - med)))[(len(before) + 1) // 2] AS spread
    FROM (
      SELECT *, list_sort(list_transform(before, lambda b: b.v))[(len(before) + 1) // 2] AS med
      FROM (
        SELECT place_id, measured_at, pm25,
               coalesce(list({{'t': measured_at, 'v': pm25}}) OVER (
                 PARTITION BY place_id ORDER BY measured_at
                 RANGE BETWEEN INTERVAL 24 HOURS PRECEDING AND INTERVAL 1 MICROSECOND PRECEDING), []) AS before
        FROM ({FACT_A})))))"""

COUNTER = """
WITH samples AS (
  SELECT user_id % 5 AS series, ts,
         sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (
           PARTITION BY user_id % 5, date_trunc('hour', ts) ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS total
  FROM events),
single AS (SELECT series, ts, max(total) AS total FROM samples GROUP BY series, ts),
prior AS (SELECT *, lag(total) OVER (PARTITION BY series ORDER BY ts) AS prior FROM single),
steps AS (
  SELECT *, CASE WHEN prior IS NULL THEN 0 WHEN total >= prior THEN total - prior ELSE total END AS step FROM prior)
SELECT series, ts, total, step, increase, increase > 0 AS firing FROM (
  SELECT *, (sum(step) OVER (PARTITION BY series ORDER BY ts
             RANGE BETWEEN INTERVAL 299999999 MICROSECOND PRECEDING AND CURRENT ROW))::BIGINT AS increase FROM steps)"""


def stream_counts() -> str:
    """Counts of three loads, added up."""
    facts = {"air_quality_current": FACT_A, "weather_current": FACT_B, "air_quality_forecast": FORECAST}
    parts = ["SELECT 'raw_rows.' || feed AS metric, count(*) AS value FROM r GROUP BY feed"]
    parts += [f"SELECT '{m}', 0" for m in ("raw_rows.unrouted", "dropped.air_quality", "dropped.weather")]
    parts += [f"SELECT 'candidates', count(*) FROM cand{n}" for n in (1, 2, 3)]
    parts += [f"SELECT 'dimension', count(*) FROM fresh{n}" for n in (1, 2, 3)]
    parts += [f"SELECT '{m}', count(*) FROM ({sql})" for f, sql in facts.items() for m in (f, f"calculated.{f}")]
    return "SELECT metric, sum(value)::BIGINT AS value FROM (" + " UNION ALL ".join(parts) + ") GROUP BY metric"


IN_PARTS = (STORED + upserted(1, "stored", PARTS[0]) + upserted(2, "upserted1", PARTS[1])
            + upserted(3, "upserted2", PARTS[2]))

ORACLE: dict[str, str] = {
    "parse_feed_a": BASE + """
SELECT event_id AS request_id, place_name, upper(trim(place_name)) AS place_key, 'FR' AS country,
       fetched_at, measured_at, CASE WHEN k % 10 = 0 THEN NULL ELSE k END AS aqi,
       CAST(nk AS DOUBLE) AS latitude,
       CASE WHEN k % 13 = 0 THEN NULL ELSE CAST(nk * 10 AS DOUBLE) END AS longitude,
       value AS pm25
FROM va""",
    "parse_feed_b": BASE + """
SELECT event_id AS request_id, place_name, fetched_at, measured_at,
       CASE WHEN k % 6 = 0 THEN NULL ELSE k END AS weather_code, value AS temperature,
       200 AS cod
FROM vb""",
    "raw_envelope": BASE + ENVELOPE,
    "raw_partition_roundtrip": BASE + """
SELECT event_id AS request_id, feed, place_raw AS place_name, http_status,
       http_status = 200 AS ok, strftime(fetched_at, '%Y-%m-%dT%H:%M:%S.000Z') AS fetched_at_utc,
       CAST(fetched_at AS DATE) AS dt, strftime(fetched_at, '%H') AS hour
FROM r""",
    "request_manifest": f"""
SELECT c.c_name AS place_name, n.n_name AS country, f.feed,
  CASE WHEN f.feed = 'air_quality'
       THEN 'https://api.waqi.info/feed/' || replace(url_encode(c.c_name), '%2F', '/')
            || '/?token=***'
       ELSE 'https://api.openweathermap.org/data/2.5/weather?q='
            || replace(url_encode(c.c_name || ',' || lower(n.n_name)), '%2F', '/')
            || '&appid=***&units=metric&lang=fr' END AS url
FROM {CUSTOMER_PLACES},
     (VALUES ('air_quality'), ('weather')) f(feed)""",
    "raw_ingest_hour": """
WITH m AS (
  SELECT c.c_name AS place_name, n.n_name AS country, f.feed, CAST(substr(c.c_name, 10) AS INTEGER) AS n,
    CASE WHEN f.feed = 'air_quality'
         THEN 'https://api.waqi.info/feed/' || replace(url_encode(c.c_name), '%2F', '/')
              || '/?token=***'
         ELSE 'https://api.openweathermap.org/data/2.5/weather?q='
              || replace(url_encode(c.c_name || ',' || lower(n.n_name)), '%2F', '/')
              || '&appid=***&units=metric&lang=fr' END AS url
  FROM {places},
       (VALUES ('air_quality'), ('weather')) f(feed)
),
s AS (
  SELECT *, CASE WHEN n % 17 = 0 THEN 0 WHEN n % 11 = 0 THEN 500
                 WHEN feed = 'weather' AND n % 5 = 0 THEN 404 ELSE 200 END AS http_status
  FROM m
)
SELECT feed, place_name, country, url, http_status, http_status = 200 AS ok,
  CASE WHEN http_status = 200 THEN NULL WHEN http_status = 0 THEN 'ERROR: timeout ' || url
       ELSE 'HTTP_' || http_status END AS error,
  '2024-01-31T09:00:12.345Z' AS fetched_at_utc,
  CASE WHEN http_status = 0 THEN 'ERROR: timeout ' || url WHEN http_status = 500 THEN ''
       WHEN http_status = 404 THEN '{"cod":"404","message":"city not found"}'
       WHEN feed = 'air_quality' THEN '{"status":"ok","data":{"aqi":' || (n % 300) || '}}'
       ELSE '{"cod":200,"id":' || n || '}' END AS payload,
  DATE '2024-01-31' AS dt, '09' AS hour
FROM s""".replace("{places}", CUSTOMER_PLACES),
    "route_by_feed": BASE + "SELECT event_id AS request_id, feed, feed AS routed_feed FROM r",
    "partition_keys": """
SELECT event_id AS request_id, CAST(ts AS DATE) AS dt_utc, strftime(ts, '%H') AS hour_utc,
       CAST(timezone('Europe/Paris', ts AT TIME ZONE 'UTC') AS DATE) AS dt_local,
       strftime(timezone('Europe/Paris', ts AT TIME ZONE 'UTC'), '%H') AS hour_local
FROM events""",
    "dim_candidates": BASE + CANDIDATES + "SELECT * FROM cand1",
    "dim_new_rows": BASE + CANDIDATES + "SELECT * FROM fresh1",
    "dim_upsert": BASE + CANDIDATES + "SELECT * FROM upserted1",
    "dim_fill_null": BASE + CANDIDATES + """
SELECT u.place_id, u.name, u.country,
       coalesce(u.latitude, c.latitude) AS latitude, coalesce(u.longitude, c.longitude) AS longitude,
       coalesce(u.air_name, c.air_name) AS air_name,
       coalesce(u.weather_name, c.weather_name) AS weather_name
FROM upserted1 u LEFT JOIN cand1 c ON u.name = c.name AND u.country = c.country""",
    "dim_lookup": BASE + """
SELECT event_id AS request_id, place_name, fetched_at, measured_at,
       CAST(nk + 1 AS BIGINT) AS place_id
FROM va""",
    "fact_current_a": BASE + FACT_A,
    "fact_current_b": BASE + FACT_B,
    "forecast_long": BASE + FORECAST,
    "fact_staged_a": BASE + FACT_A,
    "incremental_2key": BASE + FACT_A,
    "incremental_4key": BASE + FORECAST,
    "incremental_measured": BASE + f"""
SELECT * REPLACE (CASE WHEN fetched_at >= {STORED_UNTIL} THEN fetched_at + INTERVAL 1 DAY ELSE fetched_at END AS fetched_at)
FROM ({FACT_A.replace("PARTITION BY nk, fetched_at", "PARTITION BY nk, measured_at")})""",
    "incremental_stream": BASE + FACT_A,
    "dedupe_deterministic": """
SELECT user_id, hour_ts, event_id, event_type, value FROM (
  SELECT user_id, date_trunc('hour', ts) AS hour_ts, event_id, event_type, value,
         row_number() OVER (PARTITION BY user_id, date_trunc('hour', ts) ORDER BY event_id) AS rn
  FROM events
) WHERE rn = 1""",
    "run_metrics": BASE + """
SELECT feed, count(*) AS raw_rows,
       count(*) FILTER (WHERE http_status = 200) AS ok_rows,
       count(*) FILTER (WHERE http_status = 200 AND event_type <> 'signup') AS valid_rows,
       count(*) FILTER (WHERE http_status = 200 AND event_type <> 'signup'
                        AND place_raw IS NOT NULL) AS named_rows,
       count(*) FILTER (WHERE http_status = 200 AND event_type <> 'signup'
                        AND place_raw IS NOT NULL) AS matched_rows
FROM r GROUP BY feed
UNION ALL SELECT 'unrouted', 0, 0, 0, 0, 0""",
    "failure_alert": ALERT,
    "failure_alert_stream": ALERT,
    "silver_hour": BASE + STORED + upserted(1, "stored", FIRST_HOUR) + upserted(2, "upserted1", "true")
    + silver_rows("upserted2", "true"),
    "silver_rerun": BASE + CANDIDATES + silver_rows("upserted1", "true"),
    "silver_rerun_alias": SPELLED_BASE + CANDIDATES + SPELLED_IDS
    + silver_rows("upserted1", "true", "spelled", "event_id % 4 >= 2, event_id"),
    "silver_metrics": BASE + CANDIDATES + silver_counts(),
    "silver_stream": BASE + IN_PARTS + silver_rows("upserted3", "true"),
    "silver_stream_metrics": BASE + IN_PARTS + stream_counts(),
    "rejected_rows": BASE + REJECTS + "SELECT event_id AS request_id, dt, array_to_string(reasons, ',') AS reasons FROM reasons",
    "rejected_counts": BASE + REJECTS + """
SELECT unnest(CASE WHEN len(reasons) = 0 THEN ['accepted', 'raw'] ELSE list_append(reasons, 'raw') END) AS reason,
       count(*) AS rows FROM reasons GROUP BY 1
UNION ALL
SELECT 'accepted, bad_field', count(*) FROM reasons
WHERE len(reasons) = 0 AND readable AND feed = 'air_quality' AND k % 10 = 0""",
    "catch_up_plan": BASE + CATCH_UP,
    "catch_up_load": BASE + catch_up_rows(),
    "forecast_in_force": BASE + IN_FORCE,
    "alert_episodes": EPISODES,
    "alert_episodes_stream": EPISODES,
    "extreme_variations": BASE + VARIATIONS,
    "counter_alert": COUNTER,
}
