"""UTC instants, local wall clocks, days and weeks.

`_utc` columns are instants. `_kst` columns are wall clocks stored as timestamps and
must never be fed to epoch functions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, SparkSession, functions as F

# Fixed value: the zone whose days and weeks are counted.
LOCAL_ZONE = "Asia/Seoul"


def epoch_seconds(instant_utc: Column) -> Column:
    """Whole seconds since 1970; sub-seconds are cut off before any subtraction."""
    return F.unix_seconds(instant_utc)


def kst_wall_clock(instant_utc: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.from_utc_timestamp(instant_utc, zone)


def utc_day(instant_utc: Column) -> Column:
    return F.to_date(instant_utc)


def week_start(day: Column) -> Column:
    """Monday of the day's week, as a TIMESTAMP at midnight."""
    return F.date_trunc("week", day)


def as_date(value: str | dt.date) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def day_literal(value: str | dt.date) -> Column:
    return F.lit(as_date(value))


def checked_range(start: str | dt.date, end: str | dt.date) -> tuple[dt.date, dt.date]:
    first, last = as_date(start), as_date(end)
    if first > last:
        raise ValueError(f"start date {first} is after end date {last}")
    return first, last


def require_utc_session(spark: SparkSession) -> None:
    """Time texts are read, and days are cut, in the session zone; it has to be UTC."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")
