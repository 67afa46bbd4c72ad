"""One scheduled hour: the raw job, then the silver job on the hour it landed.

The scheduler passes the run's instant (ISO text with an offset).  The raw
job stamps every response with it and lands the UTC hour it falls in; the
silver job then opens exactly that partition folder.  Rerunning the hour
replaces the raw hour (same stamp, same rows) and the silver step appends
nothing, because every append is an anti join on the business key.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession

from obslake.plans import raw_hour, silver


def landed_hour(run_ts_iso: str) -> tuple[str, str]:
    """(dt, hour) of the UTC hour a run instant falls in."""
    t = _dt.datetime.fromisoformat(run_ts_iso)
    if t.tzinfo is None:
        raise ValueError(f"run instant needs an offset: {run_ts_iso!r}")
    u = t.astimezone(_dt.timezone.utc)
    return u.date().isoformat(), f"{u.hour:02d}"


def run(spark: SparkSession, run_ts_iso: str, places: DataFrame, tokens: dict[str, str],
        fetcher: Callable[[str], tuple[int, str]], raw_root: str | Mapping[str, str],
        dimension_in: str, dimension_out: str, facts_root: str,
        parallelism: int | None = None, country_col: str | None = None,
        fill_null: bool = False, concurrency: int = 1) -> dict[str, int]:
    """Land the run's responses, then build the silver tables for that hour.
    Returns the silver job's counts (rows inserted per target, raw rows per
    feed)."""
    raw_hour.run(spark, places, tokens, raw_root, fetcher, run_ts_iso,
                 parallelism=parallelism, country_col=country_col, concurrency=concurrency)
    dt, hour = landed_hour(run_ts_iso)
    return silver.run(spark, raw_root, dimension_in, dimension_out, facts_root, dt=dt, hour=hour,
                      fill_null=fill_null)
