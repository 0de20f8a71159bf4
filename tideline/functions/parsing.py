"""Null-on-error typing of raw strings; safe under ANSI mode."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_event_time(raw: Column, fmt: str | None = None) -> Column:
    """UTC timestamp of a raw time text, null where it is not one.

    A single trailing " UTC" is dropped first. Without ``fmt`` Spark's own lenient
    forms are accepted (a bare year, a zone suffix, `now`, ...); pass
    ``"yyyy-MM-dd HH:mm:ss"`` to accept nothing else. Needs a UTC session zone.
    """
    text = F.when(
        F.endswith(raw, F.lit(" UTC")), F.substring(raw, F.lit(1), F.length(raw) - 4)
    ).otherwise(raw)
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def to_bigint(raw: Column) -> Column:
    return raw.try_cast("bigint")


def to_double(raw: Column) -> Column:
    return raw.try_cast("double")
