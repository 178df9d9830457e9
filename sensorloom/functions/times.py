"""Time helpers that do not depend on the session time zone.

Timestamps are UTC instants; a TIMESTAMP_NTZ column is taken as UTC wall time.
"""

from __future__ import annotations

import math
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_ntz(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.TimestampNTZType)


def moment(value: Column | datetime, ntz: bool = False) -> Column:
    """A bound to compare timestamps with; a datetime without a zone is UTC."""
    if not isinstance(value, datetime):
        return value
    wall = value.astimezone(timezone.utc) if value.tzinfo else value
    text = wall.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.expr(f"TIMESTAMP_NTZ '{text}'" if ntz else f"TIMESTAMP '{text}+00:00'")


def utc_day(ts: Column, ntz: bool = False) -> Column:
    """UTC date of a timestamp."""
    if ntz:
        return F.to_date(ts)
    days = F.floor(F.unix_seconds(ts) / F.lit(86400)).cast("int")
    return F.date_from_unix_date(days)


def utc_hour(ts: Column, ntz: bool = False) -> Column:
    """UTC hour of the day, 0..23."""
    if ntz:
        return F.hour(ts)
    return F.pmod(F.floor(F.unix_seconds(ts) / F.lit(3600)), F.lit(24)).cast("int")


# Casts between TIMESTAMP and TIMESTAMP_NTZ, differences of TIMESTAMPs and
# date_format all go through the session's local time, which skips and repeats hours
# where clocks change. The helpers below count from the epoch instead.
EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def as_utc_ntz(ts: Column) -> Column:
    """UTC wall time of an instant, as TIMESTAMP_NTZ."""
    seconds = (F.unix_micros(ts).cast("decimal(20,0)") / 1000000).cast("decimal(18,6)")
    return F.expr(EPOCH) + F.make_dt_interval(secs=seconds)


def as_utc_instant(wall: Column) -> Column:
    """The instant of a UTC wall time given as TIMESTAMP_NTZ."""
    return F.timestamp_seconds(_seconds(wall - F.expr(EPOCH)))


def _seconds(interval: Column) -> Column:
    return interval.cast("interval second").cast("decimal(20,6)")


def seconds_between(start: Column, end: Column, ntz: bool = False) -> Column:
    """Seconds from ``start`` to ``end`` as a double."""
    if ntz:
        return _seconds(end - start).cast("double")
    return (F.unix_micros(end) - F.unix_micros(start)) / 1e6


def shifted(ts: Column, by: timedelta, ntz: bool = False) -> Column:
    """``ts`` moved by a fixed time; a day is 24 hours."""
    if ntz:
        return ts + F.lit(by)
    return F.timestamp_micros(F.unix_micros(ts) + F.lit(by // timedelta(microseconds=1)))


def iso_timestamp(ts: Column, ntz: bool = False) -> Column:
    """ISO-8601 text with ``+00:00``; microseconds only where they are not zero."""
    text = (ts if ntz else as_utc_ntz(ts)).cast("string")
    fraction = F.substring(text, 20, 7)
    return F.concat(
        F.substring(text, 1, 10),
        F.lit("T"),
        F.substring(text, 12, 8),
        F.when(fraction == "", "").otherwise(F.rpad(fraction, 7, "0")),
        F.lit("+00:00"),
    )


def diurnal_factor(hour: Column) -> Column:
    """Time-of-day multiplier of the expected levels for an hour of the day."""
    # Phases and weights of the two waves.
    daily = F.sin((hour - 6) / 24 * (2 * math.pi))
    half_daily = F.sin((hour - 18) / 12 * (2 * math.pi))
    return F.lit(1.0) + 0.4 * daily + 0.4 * half_daily
