"""Bronze -> Silver: sessionized events of a range of local days."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tideline import schemas
from tideline.functions.clock import (
    LOCAL_ZONE,
    checked_range,
    day_literal,
    require_utc_session,
)
from tideline.operators.cleaning import clean_events, typed_events
from tideline.operators.ranges import days_between
from tideline.operators.sessions import (
    GAP_SECONDS,
    check_gap,
    open_sessions,
    sessionize,
    sessionize_from,
)
from tideline.plans.audit import recorded_run
from tideline.plans.lake import Lake
from tideline.sinks import (
    create_layer_table,
    forget_partitions,
    known_days,
    publish_days,
    register_days,
    replace_clustered_days,
    replace_days,
    restore_published,
    write_version,
)
from tideline.sources import read_bronze_range, read_silver

# Fixed value: the default look-back before a range.
BUFFER_DAYS = 2
DAY_SECONDS = 86_400


@dataclass(frozen=True)
class Ingested:
    """``empty_days`` had no rows in this run; a partition they had before is kept."""

    rows: int
    written_days: list[dt.date] = field(default_factory=list)
    empty_days: list[dt.date] = field(default_factory=list)


def silver_range(
    bronze: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    gap_seconds: int = GAP_SECONDS,
    zone: str = LOCAL_ZONE,
    time_format: str | None = None,
) -> DataFrame:
    """Silver rows of local days ``start`` to ``end`` from Bronze rows with look-back.

    Sessions are cut over all rows given. The day filter reaches below the join, so
    full rows of the look-back days are not shuffled.
    """
    silver = sessionize(clean_events(typed_events(bronze, time_format), zone), gap_seconds)
    return days_between(silver, schemas.SILVER_DAY, start, end)


def ingest(
    spark: SparkSession,
    lake: Lake,
    start: str | dt.date,
    end: str | dt.date,
    gap_seconds: int = GAP_SECONDS,
    buffer_days: int = BUFFER_DAYS,
    run_id: str | None = None,
    zone: str = LOCAL_ZONE,
    time_format: str | None = None,
    drop_empty_days: bool = False,
) -> Ingested:
    """Sessionizes local days ``start`` to ``end`` and replaces them in Silver.

    Reads Bronze from ``buffer_days`` before the range, and always all UTC days that hold
    its local days. A session that runs on through the whole look-back gets its start
    there; the buffer must be long against sessions (``ingest_onward`` has no such limit).
    The day after ``end`` is not refreshed, even where one of its sessions began within
    the range. ``drop_empty_days`` also takes days of the range that have no rows any
    more out of the table.
    """
    first, last = checked_range(start, end)
    require_utc_session(spark)
    with recorded_run(
        spark, lake.audit_path, run_id, lake.bronze.path, lake.silver.path, first, last
    ) as run:
        utc_first, utc_last = _utc_days(first, last, zone)
        bronze = read_bronze_range(
            spark,
            bronze_names(lake),
            min(utc_first, first - dt.timedelta(days=check_buffer(buffer_days))),
            max(utc_last, last),
        )
        silver = silver_range(bronze, first, last, gap_seconds, zone, time_format)
        done = _replace_silver(spark, lake, silver, first, last, drop_empty_days)
        run.row_count = done.rows
        run.wrote(done.written_days)
    return done


def check_buffer(buffer_days: int) -> int:
    if buffer_days < 0:
        raise ValueError("buffer_days must not be negative")
    return buffer_days


def bronze_names(lake: Lake) -> list[str]:
    return [lake.bronze.name, lake.bronze_loads.name]


def onward_range(
    bronze: DataFrame,
    silver: DataFrame,
    start: str | dt.date,
    end: str | dt.date,
    gap_seconds: int = GAP_SECONDS,
    zone: str = LOCAL_ZONE,
    time_format: str | None = None,
) -> DataFrame:
    """Silver rows of ``start`` to ``end``, continuing the sessions of earlier Silver.

    Equal to a run over all history if Silver is right up to the day before ``start``.
    """
    first, last = checked_range(start, end)
    earlier = days_between(silver, schemas.SILVER_DAY, *_look_back(first, gap_seconds))
    midnight_utc = F.to_utc_timestamp(day_literal(first).cast("timestamp"), zone)
    new = days_between(
        clean_events(typed_events(bronze, time_format), zone),
        schemas.SILVER_DAY,
        first,
        last,
    )
    return sessionize_from(
        new, open_sessions(earlier, midnight_utc, gap_seconds), gap_seconds
    )


def _look_back(first: dt.date, gap_seconds: int) -> tuple[dt.date, dt.date]:
    """Local days in which a session that is still open at ``first`` was last active."""
    days = 1 + check_gap(gap_seconds) // DAY_SECONDS
    return first - dt.timedelta(days=days), first - dt.timedelta(days=1)


def _check_look_back(
    spark: SparkSession, lake: Lake, first: dt.date, gap_seconds: int, zone: str, time_format: str | None
) -> None:
    """Raises if Bronze has events on look-back days that Silver has no partition for."""
    begin, end = _look_back(first, gap_seconds)
    bronze = read_bronze_range(spark, bronze_names(lake), *_utc_days(begin, end, zone))
    clean = clean_events(typed_events(bronze, time_format), zone)
    days = days_between(clean, schemas.SILVER_DAY, begin, end).select(schemas.SILVER_DAY).distinct()
    needed = {row[0] for row in days.collect()}  # a row for each look-back day at most
    missing = sorted(needed - known_days(spark, lake.silver, schemas.SILVER_DAY))
    if missing:
        raise ValueError(f"Silver lacks days to go on from: {', '.join(map(str, missing))}")


def ingest_onward(
    spark: SparkSession,
    lake: Lake,
    start: str | dt.date,
    end: str | dt.date,
    gap_seconds: int = GAP_SECONDS,
    run_id: str | None = None,
    zone: str = LOCAL_ZONE,
    time_format: str | None = None,
    from_nothing: bool = False,
    drop_empty_days: bool = False,
) -> Ingested:
    """Like ``ingest``, but exact without a look-back: Silver itself is carried on.

    Raises if Silver lacks a day just before ``start`` that Bronze has events on;
    ``from_nothing`` lets sessions start anew there, as for the first range of all.
    """
    first, last = checked_range(start, end)
    require_utc_session(spark)
    with recorded_run(
        spark, lake.audit_path, run_id, lake.bronze.path, lake.silver.path, first, last
    ) as run:
        create_silver(spark, lake)
        if not from_nothing:
            _check_look_back(spark, lake, first, gap_seconds, zone, time_format)
        bronze = read_bronze_range(spark, bronze_names(lake), *_utc_days(first, last, zone))
        silver = read_silver(spark, lake.silver.name)
        onward = onward_range(bronze, silver, first, last, gap_seconds, zone, time_format)
        done = _replace_silver(spark, lake, onward, first, last, drop_empty_days)
        run.row_count = done.rows
        run.wrote(done.written_days)
    return done


def create_silver(spark: SparkSession, lake: Lake) -> None:
    known = not lake.silver.versioned or spark.catalog.tableExists(lake.silver.name)
    create_layer_table(spark, lake.silver, schemas.SILVER, schemas.SILVER_DAY)
    if not known:
        restore_published(spark, lake.silver, schemas.SILVER_DAY)


def _utc_days(
    first: dt.date, last: dt.date, zone: str = LOCAL_ZONE
) -> tuple[dt.date, dt.date]:
    """UTC days that hold the local days ``first`` to ``last``."""
    local = ZoneInfo(zone)
    begin = dt.datetime.combine(first, dt.time.min, local)
    end = dt.datetime.combine(last, dt.time.max, local)
    return begin.astimezone(dt.UTC).date(), end.astimezone(dt.UTC).date()


def _replace_silver(
    spark: SparkSession,
    lake: Lake,
    silver: DataFrame,
    first: dt.date,
    last: dt.date,
    drop_empty_days: bool = False,
) -> Ingested:
    create_silver(spark, lake)
    rows, written = write_silver(spark, lake, silver)
    span = (last - first).days + 1
    empty = sorted({first + dt.timedelta(days=n) for n in range(span)} - set(written))
    if drop_empty_days:
        stale = known_days(spark, lake.silver, schemas.SILVER_DAY) & set(empty)
        if lake.silver.versioned:
            publish_days(spark, lake.silver, schemas.SILVER_DAY, None, sorted(stale))
        else:
            forget_partitions(spark, lake.silver, [{schemas.SILVER_DAY: day} for day in sorted(stale)])
    return Ingested(rows, written, empty)


def write_silver(spark: SparkSession, lake: Lake, silver: DataFrame) -> tuple[int, list[dt.date]]:
    """Replaces the days that the rows have; returns their number and the days."""
    seen = Observation("silver")
    # At most one entry per day of the range.
    metrics = (
        F.count(F.lit(1)).alias("rows"),
        F.sort_array(F.collect_set(schemas.SILVER_DAY)).alias("days"),
    )
    rows = silver.select(*schemas.SILVER.names)
    if lake.silver.versioned:
        version = write_version(rows, lake.silver, schemas.SILVER_DAY, observation=seen, metrics=metrics)
        written = list(seen.get.get("days") or [])
        publish_days(spark, lake.silver, schemas.SILVER_DAY, version, written)
        return seen.get.get("rows", 0), written
    if lake.silver.buckets:
        replace_clustered_days(rows, lake.silver, schemas.SILVER_DAY, observation=seen, metrics=metrics)
    else:
        replace_days(rows, lake.silver.path, schemas.SILVER_DAY, observation=seen, metrics=metrics)
    written = list(seen.get.get("days") or [])
    register_days(spark, lake.silver, schemas.SILVER_DAY, written)
    return seen.get.get("rows", 0), written
