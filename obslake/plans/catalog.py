"""Registered queries: every operator of the blueprint run over the driver
tables (whole tables; the feeds are derived from them, see
:mod:`obslake.plans.derived_feed`).

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame whose columns
match the oracle SQL of :mod:`obslake.plans.oracle`.  Entries that land data
(raw round trip, incremental loads, stream, silver job) write under the
shared folder (``spark.checkpoint.dir``), always to a fresh path.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from obslake import specs
from obslake.functions import time as tf
from obslake.functions.urls import redact_secrets
from obslake.operators import alert, asof, dedupe, dims, episodes, facts, incremental, ledger, metrics, parse, rejects, series, staged
from obslake.operators.lookup import attach_place
from obslake.plans import derived_feed, raw_hour, silver
from obslake.sources import fetch, raw, tables
from obslake.streaming import alert as stream_alert
from obslake.streaming import episodes as stream_episodes
from obslake.streaming import incremental as stream_inc

A, B = specs.AIR_QUALITY, specs.WEATHER
# Fixed value: facts with a fetch time before this instant are "already
# stored" in the incremental-load queries (the month is loaded in two runs).
STORED_UNTIL = "2024-01-16 00:00:00"
# Fixed value: the second load of these queries starts here, so it overlaps.
OVERLAP_FROM = "2024-01-10 00:00:00"
# The hour that the silver query loads by itself first, and the
# places (by number) that answer the first time in the rerun query.
FIRST_DT, FIRST_HOUR = "2024-01-10", "09"
ANSWERING_FIRST = 10
# The days on which the second and the third part of the month
# begin, where it lands in three parts with a stream run after each.
PART_FROM = ("2024-01-11", "2024-01-21")
# Fixed value: tasks for each core where responses are built.
TASKS_PER_CORE = 4


def _tables(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [derived_feed.load(spark, sf_dir, n) for n in names]


def envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived responses as envelopes (a projection, not landed)."""
    events, nation = _tables(spark, sf_dir, "events", "nation")
    return raw.envelope(derived_feed.responses(events, nation))


def _by_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from ``events`` range-partitioned by time: the bounds are
    sampled from cheap columns, the (expensive) derived responses are then
    built in parallel, and each task holds a contiguous run of hours.
    ``event_id`` breaks ties, so a single hot instant is still split across
    tasks.  Their number is given: the events are a small part of what each
    task builds from them, and sized by their bytes the tasks were too few."""
    events, nation = _tables(spark, sf_dir, "events", "nation")
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    return raw.envelope(derived_feed.responses(events.repartitionByRange(tasks, "ts", "event_id"), nation))


_LANDED: dict[tuple[str, str], str] = {}


def landed_root(spark: SparkSession, sf_dir: str) -> str:
    """The raw stage: land the derived envelopes once per session and
    source folder (Parquet, one folder per day, under the shared folder).
    Silver-side queries read this, as the silver job reads landed raw."""
    key = (spark.sparkContext.applicationId, sf_dir)
    root = _LANDED.get(key)
    if root is None or not tables.exists(spark, root):
        root = tables.scratch_path(spark, "landed")
        raw.land(_by_hour(spark, sf_dir), root, fmt="parquet", partition_by=("dt",))
        _LANDED[key] = root
    return root


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw.read_raw(spark, landed_root(spark, sf_dir), fmt="parquet")


def parsed(spark: SparkSession, sf_dir: str, spec: specs.FeedSpec) -> DataFrame:
    return parse.parse_feed(parse.route_feed(landed(spark, sf_dir), spec), spec)


def place_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    (nation,) = _tables(spark, sf_dir, "nation")
    return derived_feed.nation_dimension(nation)


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dims.place_candidates([(parsed(spark, sf_dir, A), A), (parsed(spark, sf_dir, B), B)])


def stored_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    (nation,) = _tables(spark, sf_dir, "nation")
    return derived_feed.stored_dimension(nation)


# ---------------------------------------------------------------- parse
def parse_feed_a(spark, sf_dir):
    p = F.col(specs.PAYLOAD)
    return parsed(spark, sf_dir, A).select(
        "request_id", "place_name", "place_key", "country", "fetched_at", "measured_at",
        p["data"]["aqi"].alias("aqi"),
        F.get(p["data"]["city"]["geo"], 0).alias("latitude"),
        F.get(p["data"]["city"]["geo"], 1).alias("longitude"),
        p["data"]["iaqi"]["pm25"]["v"].alias("pm25"),
    )


def parse_feed_b(spark, sf_dir):
    p = F.col(specs.PAYLOAD)
    return parsed(spark, sf_dir, B).select(
        "request_id", "place_name", "fetched_at", "measured_at",
        F.get(p["weather"], 0)["id"].alias("weather_code"),
        p["main"]["temp"].alias("temperature"),
        p["cod"].alias("cod"),
    )


# ---------------------------------------------------------------- raw side
def raw_envelope(spark, sf_dir):
    return envelope(spark, sf_dir).drop("payload")


def raw_partition_roundtrip(spark, sf_dir):
    root = tables.scratch_path(spark, "raw")
    raw.land(landed(spark, sf_dir).drop("dt", "hour"), root, cluster=True)
    return raw.read_raw(spark, root).select(
        "request_id", "feed", "place_name", "http_status", "ok", "fetched_at_utc", "dt", "hour")


def _customer_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places to fetch: every customer, with its nation as the country; each
    seventh name is a place in the next nation too."""
    customer, nation = _tables(spark, sf_dir, "customer", "nation")
    own = F.col("c_nationkey")
    both = F.when(F.col("c_custkey") % 7 == 0, F.array(own, (own + 1) % 25)).otherwise(F.array(own))
    return (customer.select("c_name", F.explode(both).alias("of")).join(nation, F.col("of") == F.col("n_nationkey"))
            .select(F.col("c_name").alias("place_name"), F.col("n_name").alias("country")))


TOKENS = {A.name: derived_feed.FAKE_TOKEN, B.name: derived_feed.FAKE_TOKEN}
# Fixed value: the fetch stamp of the registered raw-ingest run, as the
# scheduler renders it (ISO with an offset); it lands in the UTC hour
# dt=2024-01-31 / hour=09.
RUN_STAMP = "2024-01-31T10:00:12.345+01:00"


def request_manifest(spark, sf_dir):
    m = fetch.manifest(_customer_places(spark, sf_dir), [A, B], TOKENS, country_col="country")
    return m.select("place_name", "country", "feed", redact_secrets(F.col("url")).alias("url"))


def raw_ingest_hour(spark, sf_dir):
    """The raw job for one run: manifest -> fetch on the executors (the
    injected stand-in client) -> envelope -> JSON hour partition, read back
    partition-pruned."""
    root = tables.scratch_path(spark, "raw-hour")
    raw_hour.run(spark, _customer_places(spark, sf_dir), TOKENS, root, derived_feed.stand_in_fetch,
                 RUN_STAMP, parallelism=spark.sparkContext.defaultParallelism,
                 country_col="country")
    return raw.read_raw(spark, root, dt="2024-01-31", hour="09").select(
        "feed", "place_name", "country", "url", "http_status", "ok", "error", "fetched_at_utc", "payload",
        "dt", "hour")


def route_by_feed(spark, sf_dir):
    env = landed(spark, sf_dir)
    routed = [parse.route_feed(env, f).select("request_id", "feed", F.lit(f.name).alias("routed_feed"))
              for f in (A, B)]
    return routed[0].unionByName(routed[1])


def partition_keys(spark, sf_dir):
    (events,) = _tables(spark, sf_dir, "events")
    dt_utc, hour_utc = tf.partition_keys(F.col("ts"))
    dt_loc, hour_loc = tf.partition_keys(F.col("ts"), "Europe/Paris")
    return events.select(F.col("event_id").alias("request_id"),
                         dt_utc.alias("dt_utc"), hour_utc.alias("hour_utc"),
                         dt_loc.alias("dt_local"), hour_loc.alias("hour_local"))


# ---------------------------------------------------------------- dimension
def dim_candidates(spark, sf_dir):
    return candidates(spark, sf_dir)


def dim_new_rows(spark, sf_dir):
    return dims.new_places(candidates(spark, sf_dir), stored_dimension(spark, sf_dir))


def dim_upsert(spark, sf_dir):
    return dims.upsert_places(stored_dimension(spark, sf_dir), candidates(spark, sf_dir))


def dim_fill_null(spark, sf_dir):
    return dims.fill_null_details(stored_dimension(spark, sf_dir), candidates(spark, sf_dir))


def dim_lookup(spark, sf_dir):
    rows = parsed(spark, sf_dir, A).select("request_id", "place_name", "place_key", "country",
                                           "fetched_at", "measured_at")
    return attach_place(rows, place_dimension(spark, sf_dir))


# ---------------------------------------------------------------- facts
def fact_current_a(spark, sf_dir):
    return facts.current_fact(parsed(spark, sf_dir, A), place_dimension(spark, sf_dir),
                              specs.AIR_QUALITY_CURRENT)


def fact_current_b(spark, sf_dir):
    return facts.current_fact(parsed(spark, sf_dir, B), place_dimension(spark, sf_dir),
                              specs.WEATHER_CURRENT)


def forecast_long(spark, sf_dir):
    return facts.forecast_fact(parsed(spark, sf_dir, A), place_dimension(spark, sf_dir),
                               specs.AIR_QUALITY_FORECAST)


def staged_root(spark: SparkSession, sf_dir: str) -> str:
    """The landed envelopes staged with parsed bodies, in a folder per day."""
    root = tables.scratch_path(spark, "staged")
    (staged.stage(landed(spark, sf_dir)).sortWithinPartitions("dt")
     .write.partitionBy("dt").parquet(root))
    return root


def fact_staged_a(spark, sf_dir):
    """The air-quality fact from staged bodies: no JSON is parsed for it."""
    rows = spark.read.schema(staged.STAGED).parquet(staged_root(spark, sf_dir))
    parsed_rows = parse.validate(staged.parse_staged(rows, A), A)
    return facts.current_fact(parsed_rows, place_dimension(spark, sf_dir), specs.AIR_QUALITY_CURRENT)


def dedupe_deterministic(spark, sf_dir):
    (events,) = _tables(spark, sf_dir, "events")
    rows = events.select("user_id", tf.floor_to(F.col("ts"), "hour").alias("hour_ts"),
                         "event_id", "event_type", "value")
    return dedupe.dedupe(rows, ["user_id", "hour_ts"], "event_id", keep_order=True)


# ---------------------------------------------------------------- incremental
def _two_loads(spark, first: DataFrame, second: DataFrame, keys, key_buckets: int | None = None) -> DataFrame:
    """Append two batches that overlap; what the target holds then."""
    target = tables.scratch_path(spark, "fact")
    for batch in (first, second):
        incremental.append_unseen(spark, batch, target, keys, key_buckets=key_buckets)
    return spark.read.parquet(target).drop("fetched_date")


def _fetched(batch: DataFrame, lo: str | None = None, hi: str | None = None) -> DataFrame:
    at = F.col("fetched_at")
    if lo is not None:
        batch = batch.where(at >= F.lit(lo).cast("timestamp_ntz"))
    return batch if hi is None else batch.where(at < F.lit(hi).cast("timestamp_ntz"))


def incremental_2key(spark, sf_dir):
    fact = fact_current_a(spark, sf_dir)
    return _two_loads(spark, _fetched(fact, hi=STORED_UNTIL), _fetched(fact, lo=OVERLAP_FROM),
                      specs.AIR_QUALITY_CURRENT.keys)


def incremental_4key(spark, sf_dir):
    fact = forecast_long(spark, sf_dir)
    return _two_loads(spark, _fetched(fact, hi=STORED_UNTIL), _fetched(fact, lo=OVERLAP_FROM),
                      specs.AIR_QUALITY_FORECAST.keys)


def incremental_measured(spark, sf_dir):
    """A key without the fetch time, stored as a bucketed table: readings
    fetched again a day later are not stored again."""
    spec = replace(specs.AIR_QUALITY_CURRENT, keys=("place_id", "measured_at"))
    fact = facts.current_fact(parsed(spark, sf_dir, A), place_dimension(spark, sf_dir), spec)
    later = fact.withColumn("fetched_at", F.timestamp_add("DAY", F.lit(1), F.col("fetched_at")))
    return _two_loads(spark, _fetched(fact, hi=STORED_UNTIL), later, spec.keys, key_buckets=8)


def _part(day, n: int):
    """Whether a day is in part ``n`` (0 to 2) of the month."""
    lo, hi = (None, *PART_FROM)[n], (*PART_FROM, None)[n]
    since = F.lit(True) if lo is None else day >= F.lit(lo).cast("date")
    return since if hi is None else since & (day < F.lit(hi).cast("date"))


def _landed_in_parts(spark, sf_dir, run: Callable[[str], object]) -> None:
    """Land the month in three parts; ``run`` after each on what is there."""
    root = tables.scratch_path(spark, "raw-parts")
    for n in range(3):
        raw.land(landed(spark, sf_dir).where(_part(F.col("dt"), n)).drop("dt", "hour"), root, fmt="parquet",
                 partition_by=("dt",))
        run(root)


def incremental_stream(spark, sf_dir):
    """One fact as a stream, over a micro-batch or more for each part of the
    month."""
    target, state = tables.scratch_path(spark, "stream-fact"), tables.scratch_path(spark, "stream-ckpt")
    _landed_in_parts(spark, sf_dir, lambda root: stream_inc.run_available(
        spark, root, place_dimension(spark, sf_dir), specs.AIR_QUALITY_CURRENT, target, state, fmt="parquet"))
    return spark.read.parquet(target).drop("fetched_date")


# ---------------------------------------------------------------- metrics
def run_metrics(spark, sf_dir):
    return metrics.feeds_metrics(landed(spark, sf_dir), [A, B], place_dimension(spark, sf_dir))


def failure_alert(spark, sf_dir):
    (events,) = _tables(spark, sf_dir, "events")
    return alert.failure_alert(events, "ts", F.col("event_type") == F.lit("error"))


def _events_in_parts(spark, sf_dir, run: Callable[[DataFrame], object]) -> None:
    """Write ``events`` to a folder in three parts; ``run`` on the folder as a
    stream after each."""
    (events,) = _tables(spark, sf_dir, "events")
    folder = tables.scratch_path(spark, "events")
    for n in range(3):
        events.where(_part(F.to_date("ts"), n)).write.mode("append").parquet(folder)
        run(spark.readStream.schema(events.schema).parquet(folder))


def failure_alert_stream(spark, sf_dir):
    """The alert as a stream over three parts of ``events``: raised windows go
    to a Parquet table and are read back, all of them."""
    target, state = tables.scratch_path(spark, "alert-stream"), tables.scratch_path(spark, "alert-stream-ckpt")
    _events_in_parts(spark, sf_dir, lambda source: stream_alert.run_available(
        source, "ts", F.col("event_type") == F.lit("error"), target, state))
    return stream_alert.read_alerts(spark, target)


def alert_episodes(spark, sf_dir):
    """Firing windows of the alert merged into episodes."""
    return episodes.episodes(failure_alert(spark, sf_dir))


def alert_episodes_stream(spark, sf_dir):
    """The same from the stream, over three parts of ``events``."""
    root, state = tables.scratch_path(spark, "episodes"), tables.scratch_path(spark, "episodes-ckpt")
    versions = [0]
    _events_in_parts(spark, sf_dir, lambda source: versions.append(stream_episodes.run_available(
        source, "ts", F.col("event_type") == F.lit("error"), root, state)))
    return stream_episodes.read(spark, root, max(versions))


def _silver_base(spark, sf_dir) -> str:
    base = tables.scratch_path(spark, "silver")
    stored_dimension(spark, sf_dir).write.parquet(f"{base}/dimension/v0")
    return base


def silver_hour(spark, sf_dir):
    """The silver job in two loads, a single hour and then every landed hour
    (that one included): every row of the facts and the dimension."""
    base, root = _silver_base(spark, sf_dir), landed_root(spark, sf_dir)
    versions = [f"{base}/dimension/v{i}" for i in range(3)]
    silver.run(spark, root, versions[0], versions[1], base, FIRST_DT, FIRST_HOUR, fmt="parquet")
    silver.run(spark, root, versions[1], versions[2], base, fmt="parquet")
    return silver.stored_tables(spark, base, versions[2])


def _loaded_twice(spark, sf_dir, rows: DataFrame, first) -> DataFrame:
    """Land the rows of ``first`` and run silver; land all of them anew and
    run again from the same dimension version: every row stored then."""
    base, root = _silver_base(spark, sf_dir), tables.scratch_path(spark, "raw-again")
    for part in (rows.where(first), rows):
        raw.land(part, root, fmt="parquet", partition_by=("dt",))
        silver.run(spark, root, f"{base}/dimension/v0", f"{base}/dimension/v1", base, fmt="parquet")
    return silver.stored_tables(spark, base, f"{base}/dimension/v1")


def silver_rerun(spark, sf_dir):
    """Every hour loaded with few places answering, landed anew with all of
    them and run again."""
    number = F.regexp_extract(F.lower("place_name"), r"nation_(\d+)", 1).try_cast("int")
    return _loaded_twice(spark, sf_dir, landed(spark, sf_dir).drop("dt", "hour"), number < ANSWERING_FIRST)


def silver_rerun_alias(spark, sf_dir):
    """The same where half of the requests spell the place differently, with
    one lookup key for both spellings: the rerun brings the second spelling."""
    late = F.pmod("request_id", F.lit(4)) >= 2
    spelled = F.concat(F.trim("place_name"), F.when(late, F.lit(" straße")).otherwise(F.lit(" strasse")))
    rows = landed(spark, sf_dir).drop("dt", "hour").withColumn("place_name", spelled)
    return _loaded_twice(spark, sf_dir, rows, ~late)


def silver_metrics(spark, sf_dir):
    """The metrics of one silver run over every landed hour."""
    base = _silver_base(spark, sf_dir)
    found = silver.run(spark, landed_root(spark, sf_dir), f"{base}/dimension/v0", f"{base}/dimension/v1", base,
                       fmt="parquet")
    return spark.createDataFrame(sorted(found.items()), "metric string, value bigint")


def silver_stream(spark, sf_dir):
    """The silver step as a stream over the landed files, a micro-batch or more
    for each part of the month: dimension upsert and three facts per
    micro-batch; every row stored."""
    base, state = _silver_base(spark, sf_dir), tables.scratch_path(spark, "silver-ckpt")
    batches = []
    _landed_in_parts(spark, sf_dir, lambda root: batches.append(stream_inc.run_silver(
        spark, root, f"{base}/dimension", base, state, fmt="parquet")))
    return silver.stored_tables(spark, base, stream_inc.dimension_version(f"{base}/dimension", sum(batches)))


def silver_stream_metrics(spark, sf_dir):
    """The counts of that stream's micro-batches, added up."""
    base, state = _silver_base(spark, sf_dir), tables.scratch_path(spark, "silver-ckpt")
    _landed_in_parts(spark, sf_dir, lambda root: stream_inc.run_silver(
        spark, root, f"{base}/dimension", base, state, fmt="parquet", metrics_root=f"{base}/metrics"))
    return stream_inc.read_metrics(spark, f"{base}/metrics").groupBy("metric").agg(F.sum("value").alias("value"))


# ---------------------------------------------------------------- rejects
# How the landed lines are damaged, by request id: the line is
# cut in half when id % 23 = 5; the body loses its last 10 characters when
# id % 29 = 3; the URL is of another host when id % 31 = 7; the fetch stamp is
# no time when id % 37 = 11; the body's ``dt`` is left out when id % 41 = 13.
OTHER_URL = "https://example.org/other"


def _damaged_lines(env: DataFrame) -> DataFrame:
    """Envelopes as JSON lines, some of them damaged; with their day."""
    def hit(n: int, r: int):
        return F.pmod("request_id", F.lit(n)) == r

    body = F.when(hit(29, 3), F.expr("substring(payload, 1, greatest(length(payload) - 10, 0))")).otherwise(F.col("payload"))
    body = F.when(hit(41, 13), F.regexp_replace(body, r'"dt":\d+,', "")).otherwise(body)
    changed = env.withColumns({
        "payload": body,
        "url": F.when(hit(31, 7), F.lit(OTHER_URL)).otherwise(F.col("url")),
        "fetched_at_utc": F.when(hit(37, 11), F.lit("soon")).otherwise(F.col("fetched_at_utc"))})
    line = F.to_json(F.struct(*[c for c in changed.columns if c != "dt"]))
    half = F.expr("substring(line, 1, length(line) div 2)")
    return (changed.withColumn("line", line)
            .select(F.when(hit(23, 5), half).otherwise(F.col("line")).alias("value"), "dt"))


def _lines_root(spark, sf_dir) -> str:
    """The damaged lines, landed in a folder per day."""
    root = tables.scratch_path(spark, "raw-lines")
    with tables.compiled(spark):
        _damaged_lines(landed(spark, sf_dir)).write.partitionBy("dt").text(root)
    return root


def rejected_rows(spark, sf_dir):
    """Every landed line, accepted or rejected with its reasons: damaged lines
    are landed, split in one pass, and the rejected ones stored and read
    back."""
    kept = tables.scratch_path(spark, "rejected")
    lines = rejects.read_lines(spark, _lines_root(spark, sf_dir))
    accepted, rejected = rejects.split(lines, [A, B])
    rejects.store(rejected, kept)
    used = tables.scratch_path(spark, "accepted")
    with tables.compiled(spark):
        accepted.select("request_id", "dt").write.parquet(used)
    number = F.coalesce("request_id", F.regexp_extract(rejects.LINE, r'"request_id":(\d+)', 1).try_cast("bigint"))
    bad = rejects.stored(spark, kept).select(number.alias("request_id"), "dt", F.array_join("reasons", ",").alias("reasons"))
    good = spark.read.parquet(used).withColumn("reasons", F.lit(""))
    return good.unionByName(bad)


def rejected_counts(spark, sf_dir):
    """Rows by reason, and accepted rows with a field that did not parse."""
    marked = rejects.classify(rejects.read_lines(spark, _lines_root(spark, sf_dir)), [A, B])
    tables.shared_dir(spark)
    with tables.compiled(spark):
        return rejects.counts(marked, noted=True).checkpoint()


# ---------------------------------------------------------------- catch-up
# The range that the schedule expects; hours that land first
# (even ones), that land never (5 o'clock on odd days) and that land anew (even
# hours of every fifth day); and how many hours are loaded at a time.
EXPECTED = (_dt.datetime(2024, 1, 1), _dt.datetime(2024, 1, 31, 23))
HOURS_AT_ONCE = 384


def _catch_up_twice(spark, sf_dir, load: Callable[[DataFrame], object], again: bool) -> tuple[str, str]:
    """Land the even hours and catch up; land the other hours, but for those
    that never come, and some even ones anew; ``again``: catch up once more.
    (raw root, ledger)"""
    root, path = tables.scratch_path(spark, "raw-hours"), tables.scratch_path(spark, "ledger")
    env, hour, day = landed(spark, sf_dir), F.col("hour").cast("int"), F.dayofmonth("dt")
    even = hour % 2 == 0
    never = (hour == 5) & (day % 2 == 1)
    steps = [even, (~even & ~never) | (even & (day % 5 == 0))]
    for n, rows in enumerate(steps):
        raw.land(env.where(rows).drop("dt", "hour"), root, fmt="parquet", cluster=True,
                 tasks=spark.sparkContext.defaultParallelism)
        if n == 0 or again:
            ledger.catch_up(spark, root, path, *EXPECTED, load, max_hours=HOURS_AT_ONCE, fmt="parquet")
    return root, path


def catch_up_plan(spark, sf_dir):
    """What the ledger says of every expected hour, after one catch-up and
    another landing."""
    root, path = _catch_up_twice(spark, sf_dir, lambda env: env.count(), again=False)
    return ledger.plan(spark, root, path, *EXPECTED).select("dt", "hour", "status")


def catch_up_load(spark, sf_dir):
    """The silver tables after two catch-ups."""
    base = _silver_base(spark, sf_dir)
    version = [0]

    def load(env: DataFrame) -> None:
        n = version[0]
        silver.load(spark, env, f"{base}/dimension/v{n}", f"{base}/dimension/v{n + 1}", base)
        version[0] = n + 1

    _catch_up_twice(spark, sf_dir, load, again=True)
    return silver.stored_tables(spark, base, f"{base}/dimension/v{version[0]}")


# ---------------------------------------------------------------- as-of
def forecast_in_force(spark, sf_dir):
    """For every air-quality reading and pollutant the last forecast for its
    day that had been fetched by then."""
    readings = fact_current_a(spark, sf_dir)
    return asof.forecast_in_force(readings, forecast_long(spark, sf_dir), ("o3", "uvi"))


# ---------------------------------------------------------------- series
def extreme_variations(spark, sf_dir):
    """Every reading of fine dust against the day before it at its place."""
    readings = fact_current_a(spark, sf_dir).select("place_id", "measured_at", "pm25")
    return series.variations(readings, ["place_id"], "measured_at", "pm25")


# Fixed value: series of the counters, by user number.
N_SERIES = 5


def counter_alert(spark, sf_dir):
    """The alert in counter form: each series counts its errors, from zero
    again in every hour; the increase of five minutes fires."""
    (events,) = _tables(spark, sf_dir, "events")
    rows = events.select((F.col("user_id") % N_SERIES).alias("series"), F.col("ts"), "event_id",
                         (F.col("event_type") == F.lit("error")).cast("bigint").alias("failed"))
    hour = Window.partitionBy("series", tf.floor_to(F.col("ts"), "hour")).orderBy("ts", "event_id")
    samples = rows.withColumn("total", F.sum("failed").over(hour))
    found = series.counter_increase(samples, ["series"], "ts", "total")
    return found.withColumn("firing", F.col("increase") > 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "parse_feed_a": parse_feed_a,
    "parse_feed_b": parse_feed_b,
    "raw_envelope": raw_envelope,
    "raw_partition_roundtrip": raw_partition_roundtrip,
    "request_manifest": request_manifest,
    "raw_ingest_hour": raw_ingest_hour,
    "route_by_feed": route_by_feed,
    "dim_candidates": dim_candidates,
    "dim_new_rows": dim_new_rows,
    "dim_upsert": dim_upsert,
    "dim_fill_null": dim_fill_null,
    "dim_lookup": dim_lookup,
    "fact_current_a": fact_current_a,
    "fact_current_b": fact_current_b,
    "forecast_long": forecast_long,
    "fact_staged_a": fact_staged_a,
    "incremental_2key": incremental_2key,
    "incremental_4key": incremental_4key,
    "incremental_measured": incremental_measured,
    "dedupe_deterministic": dedupe_deterministic,
    "run_metrics": run_metrics,
    "failure_alert": failure_alert,
    "failure_alert_stream": failure_alert_stream,
    "incremental_stream": incremental_stream,
    "partition_keys": partition_keys,
    "silver_hour": silver_hour,
    "silver_rerun": silver_rerun,
    "silver_rerun_alias": silver_rerun_alias,
    "silver_metrics": silver_metrics,
    "silver_stream": silver_stream,
    "silver_stream_metrics": silver_stream_metrics,
    "rejected_rows": rejected_rows,
    "rejected_counts": rejected_counts,
    "catch_up_plan": catch_up_plan,
    "catch_up_load": catch_up_load,
    "forecast_in_force": forecast_in_force,
    "alert_episodes": alert_episodes,
    "alert_episodes_stream": alert_episodes_stream,
    "extreme_variations": extreme_variations,
    "counter_alert": counter_alert,
}
