"""Files as they arrive -> Bronze, Silver, the daily state and Gold, exact at any lateness.

Each micro-batch is a load of its own, by the number that the stream gives it, so one that is
run again replaces itself. The local days that it has rows on are ingested again, the days
after them repaired, and the state and Gold of those days are refreshed. Nothing depends
on a watermark: an event of any age gets its place, at the price of writing its day again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tideline import schemas
from tideline.functions.clock import LOCAL_ZONE, require_utc_session
from tideline.operators.cleaning import clean_events, typed_events
from tideline.operators.sessions import GAP_SECONDS
from tideline.plans.activity_state import refresh_state
from tideline.plans.bronze import add_load
from tideline.plans.gold import refresh_gold_weeks
from tideline.plans.lake import Lake
from tideline.plans.repair import reingest
from tideline.plans.silver import create_silver
from tideline.sinks import known_days
from tideline.streaming.sessions import read_raw_stream


def _runs(days: Iterable[dt.date]) -> Iterator[tuple[dt.date, dt.date]]:
    """First and last day of each run of days that follow each other."""
    first = last = None
    for day in sorted(days):
        if last is not None and day - last > dt.timedelta(days=1):
            yield first, last
            first = None
        first, last = first or day, day
    if last is not None:
        yield first, last


def take_in(
    spark: SparkSession,
    lake: Lake,
    raw: DataFrame,
    load_key: str,
    gap_seconds: int = GAP_SECONDS,
    zone: str = LOCAL_ZONE,
    time_format: str | None = None,
) -> list[dt.date]:
    """Stores raw rows as a load and brings all layers up to date; returns the local days that
    were written. Earlier loads must have been taken in this way, or ingested, before."""
    add_load(spark, lake, raw, load_key, run_id=f"{load_key}-bronze", time_format=time_format)
    create_silver(spark, lake)
    seen = clean_events(typed_events(raw, time_format), zone).select(schemas.SILVER_DAY).distinct()
    days, written = {row[0] for row in seen.collect()}, set()  # a row a day
    for first, last in _runs(days):
        done, repaired = reingest(
            spark, lake, first, last, gap_seconds, f"{load_key}-{first}", zone, time_format
        )
        written |= {*done.written_days, *done.empty_days, *repaired}
    refresh_state(spark, lake, written, gap_seconds, run_id=f"{load_key}-state")
    refresh_gold_weeks(spark, lake, written, run_id=f"{load_key}-gold")
    return sorted(written & known_days(spark, lake.silver, schemas.SILVER_DAY))


def stream_into_lake(
    spark: SparkSession,
    lake: Lake,
    path: str,
    checkpoint: str,
    gap_seconds: int = GAP_SECONDS,
    header: bool = True,
    files_a_batch: int = 1000,
    zone: str = LOCAL_ZONE,
    time_format: str | None = None,
) -> StreamingQuery:
    """Takes in the CSV files that have come into the folder since the last call, and stops."""
    require_utc_session(spark)

    def take(rows: DataFrame, number: int) -> None:
        take_in(rows.sparkSession, lake, rows, f"stream-{number:09d}", gap_seconds, zone, time_format)

    return (
        read_raw_stream(spark, path, header, files_a_batch)
        .writeStream.option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(take)
        .start()
    )
