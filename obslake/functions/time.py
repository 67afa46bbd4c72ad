"""Zone-independent time helpers.

Convention: every instant inside obslake is a ``timestamp_ntz`` holding the
UTC wall clock.  Nothing here depends on ``spark.sql.session.timeZone``.
``timestamp_diff``, ``date_trunc`` and ``date_format`` silently cast a
``timestamp_ntz`` to a session-zone ``timestamp`` (off by an hour around a
clock change), so they are not used on wall clocks; conversions go through
date-time fields (``make_timestamp(..., 'UTC')``, ``make_timestamp_ntz``)
and sub-day ``timestamp_add`` arithmetic, which are zone-free.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the Unix epoch as a UTC wall clock.
EPOCH_TEXT = "1970-01-01 00:00:00"


def epoch_ntz() -> Column:
    # Built from a string: a Python datetime literal would be zone-shifted.
    return F.lit(EPOCH_TEXT).cast("timestamp_ntz")


def _seconds(ts_utc: Column) -> Column:
    return F.date_part(F.lit("SECOND"), ts_utc)  # decimal, with the fraction


def utc_to_instant(ts_utc: Column) -> Column:
    """UTC wall clock -> ``timestamp`` instant."""
    return F.make_timestamp(F.year(ts_utc), F.month(ts_utc), F.dayofmonth(ts_utc),
                            F.hour(ts_utc), F.minute(ts_utc), _seconds(ts_utc), F.lit("UTC"))


def instant_to_utc(ts: Column) -> Column:
    """``timestamp`` instant -> UTC wall clock."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch_ntz())


def epoch_seconds_to_utc(seconds: Column) -> Column:
    """Epoch seconds -> UTC wall clock (no local-time string in between)."""
    return F.timestamp_add("SECOND", seconds.cast("long"), epoch_ntz())


def utc_epoch_micros(ts_utc: Column) -> Column:
    return F.unix_micros(utc_to_instant(ts_utc))


def utc_epoch_seconds(ts_utc: Column) -> Column:
    return F.unix_seconds(utc_to_instant(ts_utc))


def parse_instant(text: Column) -> Column:
    """ISO text (zone offset honoured) -> UTC wall clock; bad text -> null.

    ``try_to_timestamp`` keeps one unparsable value from failing an hour
    under ANSI mode.
    """
    return instant_to_utc(F.try_to_timestamp(text))


def floor_to(ts_utc: Column, unit: str) -> Column:
    """Truncate a wall clock to ``hour`` or ``minute`` (stays ntz)."""
    zero = F.lit(0)
    minute = F.minute(ts_utc) if unit == "minute" else zero
    if unit not in ("hour", "minute"):
        raise ValueError(unit)
    return F.make_timestamp_ntz(F.year(ts_utc), F.month(ts_utc), F.dayofmonth(ts_utc),
                                F.hour(ts_utc), minute, zero)


def format_utc_iso(ts_utc: Column) -> Column:
    """UTC wall clock -> ``2024-01-01T10:00:00.123Z`` (milliseconds kept)."""
    millis = F.floor(_seconds(ts_utc) * 1000).cast("long") % 1000
    return F.format_string("%04d-%02d-%02dT%02d:%02d:%02d.%03dZ",
                           F.year(ts_utc), F.month(ts_utc), F.dayofmonth(ts_utc),
                           F.hour(ts_utc), F.minute(ts_utc), F.second(ts_utc), millis)


def local_wall_clock(ts_utc: Column, zone: str) -> Column:
    """UTC wall clock -> wall clock in ``zone`` (exact on both sides of a
    clock change, because UTC -> local is a function)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts_utc)


def partition_keys(ts_utc: Column, zone: str = "UTC") -> tuple[Column, Column]:
    """(dt date, hour 'HH') of an instant, in ``zone``.

    Default is UTC: a local zone repeats one hour each autumn, so local
    partitions would overwrite each other; pass a zone for local keys.
    """
    wall = ts_utc if zone == "UTC" else local_wall_clock(ts_utc, zone)
    return F.to_date(wall), F.lpad(F.hour(wall).cast("string"), 2, "0")
