"""The silver job: landed raw envelopes -> dimension + three facts.

One run: read the landed hours (partition-pruned), parse each feed ONCE and
persist it, derive candidates, upsert the dimension into a new version,
build the facts, and append only rows whose key is not stored yet.  Every
step is idempotent: a rerun over the same hours appends nothing, and one
over hours landed anew adds what is new and leaves ids as they are, also
where a new spelling shares the lookup key of a known place.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake import specs
from obslake.operators import dims, facts, incremental, metrics, parse, registry
from obslake.sources import raw, tables

FEEDS = (specs.AIR_QUALITY, specs.WEATHER)
FACT_SPECS = (specs.AIR_QUALITY_CURRENT, specs.WEATHER_CURRENT)
FORECAST_SPECS = (specs.AIR_QUALITY_FORECAST,)


def feed_envelopes(spark: SparkSession, raw_root: str | Mapping[str, str], feeds,
                   dt: str | None = None, hour: str | None = None, fmt: str = "json",
                   legacy: bool = False) -> dict[str, DataFrame]:
    """Envelope rows per feed, from one root or one root per feed, in our
    layout or the older one (``legacy``)."""
    def read(root: str) -> DataFrame:
        if legacy:
            return raw.read_legacy(spark, root, feeds, dt, hour, fmt=fmt)
        return raw.read_raw(spark, root, dt, hour, fmt=fmt)
    if isinstance(raw_root, str):
        env = read(raw_root)
        return {f.name: parse.route_feed(env, f) for f in feeds}
    return {f.name: parse.route_feed(read(raw_root[f.name]), f) for f in feeds}


def run(spark: SparkSession, raw_root: str | Mapping[str, str], dimension_in: str,
        dimension_out: str, facts_root: str, dt: str | None = None, hour: str | None = None,
        fill_null: bool = False, fmt: str = "json", legacy: bool = False) -> dict[str, int]:
    """Load the landed hours.  Returns the run's metrics: rows read per feed
    (``raw_rows.<feed>``, and ``raw_rows.unrouted`` for URLs of no feed),
    ``candidates`` and places inserted (``dimension``), rows whose place the
    dimension does not know (``dropped.<feed>``), and for each fact the rows
    ``calculated.<fact>`` and inserted (``<fact>``)."""
    if isinstance(raw_root, str):
        # one root: one scan of the hour for all feeds
        env = (raw.read_legacy(spark, raw_root, FEEDS, dt, hour, fmt=fmt) if legacy
               else raw.read_raw(spark, raw_root, dt, hour, fmt=fmt))
    else:
        envs = feed_envelopes(spark, raw_root, FEEDS, dt, hour, fmt, legacy)
        env = reduce(DataFrame.unionByName, envs.values())
    return load(spark, env, dimension_in, dimension_out, facts_root, fill_null)


def load(spark: SparkSession, env: DataFrame, dimension_in: str, dimension_out: str,
         facts_root: str, fill_null: bool = False) -> dict[str, int]:
    """The silver step over envelope rows (a landed hour, or the micro-batch
    of a stream); see :func:`run`."""
    # A new version, never the path being read.  Ids and what a lookup key
    # stands for are decided once (place registry beside the facts), so a
    # retried run gives every reading the same id.
    if dimension_out.rstrip("/") == dimension_in.rstrip("/"):
        raise ValueError("dimension_out must differ from dimension_in")
    with tables.compiled(env.sparkSession):
        return _load(spark, env, dimension_in, dimension_out, facts_root, fill_null)


def _load(spark: SparkSession, env: DataFrame, dimension_in: str, dimension_out: str,
          facts_root: str, fill_null: bool) -> dict[str, int]:
    # Parse each payload once and persist the result; everything else
    # (counts, candidates, facts) reads the cache.
    both = parse.parse_payloads(env, FEEDS).persist(StorageLevel.MEMORY_AND_DISK)
    merged = None
    try:
        # one row per feed; its action also fills the cache
        raw_rows = both.groupBy(F.coalesce("feed", F.lit(metrics.UNROUTED)).alias("feed")).agg(
            F.count(F.lit(1)).alias("n"), F.min("fetched_at").alias("lo"), F.max("fetched_at").alias("hi")).collect()
        counted = {r["feed"]: r for r in raw_rows}
        out = {f"raw_rows.{name}": counted[name]["n"] if name in counted else 0
               for name in (*[f.name for f in FEEDS], metrics.UNROUTED)}
        parsed = {f.name: parse.validate(parse.feed_rows(both, f), f) for f in FEEDS}

        cands = dims.place_candidates([(parsed[f.name], f) for f in FEEDS])
        stored = spark.read.parquet(dimension_in)
        merged = dims.merge_places(stored, cands, fill_null, registry.read(spark, facts_root)).persist()
        n_new = merged.agg(F.count_if("is_new")).first()[0]
        # rebalance: AQE packs the (small) dimension into a few files
        merged.select(*dims.COLUMNS).hint("rebalance").write.mode("overwrite").parquet(dimension_out)
        places = registry.lookup(registry.update(spark, facts_root, spark.read.parquet(dimension_out)))
        out["dimension"] = n_new
        out |= _places(parsed, places)

        for spec, build in (*[(s, facts.current_fact) for s in FACT_SPECS],
                            *[(s, facts.forecast_fact) for s in FORECAST_SPECS]):
            rows = counted.get(spec.feed.name)
            bounds = (rows["lo"], rows["hi"]) if rows and rows["lo"] is not None else None
            done = incremental.append_unseen(
                spark, build(parsed[spec.feed.name], places, spec), f"{facts_root}/{spec.name}",
                spec.keys, bounds)
            out[f"calculated.{spec.name}"], out[spec.name] = done["calculated"], done["inserted"]
        return out
    finally:
        both.unpersist()
        if merged is not None:
            merged.unpersist()


def _places(parsed: Mapping[str, DataFrame], places: DataFrame) -> dict[str, int]:
    """Distinct places of the batch, and the rows of each feed whose place the
    lookup does not have (counted per place before it)."""
    per_place = [df.groupBy("place_name", "place_key", "country").agg(F.count(F.lit(1)).alias("n"))
                 .withColumn("feed", F.lit(name)) for name, df in parsed.items()]
    known = places.select("place_key", "country", F.lit(True).alias("known"))
    rows = reduce(DataFrame.unionByName, per_place).join(known, ["place_key", "country"], "left")
    found = rows.agg(F.count_distinct("place_name", "country").alias("candidates"), *[
        F.sum(F.when((F.col("feed") == name) & F.col("known").isNull(), F.col("n"))).alias(f"dropped.{name}")
        for name in parsed]).first().asDict()
    return {k: v or 0 for k, v in found.items()}


def stored_tables(spark: SparkSession, facts_root: str, dimension: str) -> DataFrame:
    """Every row of the three facts and the dimension as one table: ``fact``
    and the union of their columns."""
    parts = [spark.read.parquet(f"{facts_root}/{s.name}").drop("fetched_date").withColumn("fact", F.lit(s.name))
             for s in (*FACT_SPECS, *FORECAST_SPECS)]
    parts.append(spark.read.parquet(dimension).withColumn("fact", F.lit("dimension")))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
