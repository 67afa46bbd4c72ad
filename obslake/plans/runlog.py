"""Run log: one row per finished task, the input of the failure alert.

This replaces the metrics server and its counter rule: jobs append a task
event (task, status, start, end, detail) to a table in the shared folder,
and the alert is an ordinary windowed aggregation over that table
(:func:`obslake.operators.alert.failure_alert`), batch or stream.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obslake.functions.urls import redact_text
from obslake.operators import alert

RUN_EVENT_DDL = ("task STRING, status STRING, started_at TIMESTAMP_NTZ, "
                 "finished_at TIMESTAMP_NTZ, detail STRING")


def _utc_now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def record(spark: SparkSession, path: str, task: str, status: str,
           started_at: _dt.datetime, finished_at: _dt.datetime, detail: str | None = None) -> None:
    """Append one task event (UTC wall clocks)."""
    row = [(task, status, started_at, finished_at, detail)]
    spark.createDataFrame(row, RUN_EVENT_DDL).coalesce(1).write.mode("append").parquet(path)


def logged(spark: SparkSession, path: str, task: str, fn: Callable[..., Any],
           *args: Any, **kwargs: Any) -> Any:
    """Run ``fn`` and record its outcome; a failure is recorded, then raised."""
    started = _utc_now()
    try:
        out = fn(*args, **kwargs)
    except Exception as exc:
        record(spark, path, task, "failed", started, _utc_now(), 
               redact_text(f"{type(exc).__name__}: {exc}"))
        raise
    record(spark, path, task, "success", started, _utc_now(), None)
    return out


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_EVENT_DDL).parquet(path)


def task_failure_alert(spark: SparkSession, path: str, task_prefix: str | None = None) -> DataFrame:
    """Raised / firing windows over failed task events, by finish time."""
    failed = F.col("status") == F.lit("failed")
    if task_prefix:
        failed = failed & F.col("task").startswith(task_prefix)
    return alert.failure_alert(read(spark, path), "finished_at", failed)
