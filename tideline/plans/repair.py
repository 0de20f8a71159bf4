"""Putting later days right after a range was ingested again.

Rows that arrive late can join, split or move the session that runs over the end of their
range, and its later days in Silver still carry the old start. For each user there is at most
one such session, the one of the first event after the range, and what happens to it is one
change of its start. So the change is found at the border alone, from the range as it is now and
the first events after it, and then followed through the later days for as long as they have
rows under the old start. Only days with such rows are written again.

The days next to the border, where changes are found, are written last: a repair that failed
between finds the same changes when it is run again, and days that are done hold none of them.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline import schemas
from tideline.functions.clock import LOCAL_ZONE, as_date, day_literal, epoch_seconds, require_utc_session
from tideline.operators.ranges import days_between
from tideline.operators.sessions import GAP_SECONDS, check_gap, open_sessions, session_id_of
from tideline.plans.audit import recorded_run
from tideline.plans.lake import Lake
from tideline.plans.silver import DAY_SECONDS, Ingested, create_silver, ingest_onward, write_silver
from tideline.sinks import known_days
from tideline.sources import read_silver


def _reach(gap_seconds: int) -> dt.timedelta:
    """Days in which a session that was active on the day before can go on."""
    return dt.timedelta(days=1 + check_gap(gap_seconds) // DAY_SECONDS)


def moved_starts(
    silver: DataFrame, after: str | dt.date, gap_seconds: int = GAP_SECONDS, zone: str = LOCAL_ZONE
) -> DataFrame:
    """(user_id, old_start, new_start) of sessions that later days of Silver give another
    start than the days up to ``after`` do. One row a user at most; combined before the
    shuffle, and joined on the user."""
    last, reach = as_date(after), _reach(gap_seconds)
    one = dt.timedelta(days=1)
    border = F.to_utc_timestamp(day_literal(last + one).cast("timestamp"), zone)
    earlier = days_between(silver, schemas.SILVER_DAY, last + one - reach, last)
    first_events = (
        days_between(silver, schemas.SILVER_DAY, last + one, last + reach)
        .groupBy("user_id")
        .agg(
            F.min("event_time_utc").alias("first_event"),
            F.min_by("session_start_utc", "event_time_utc").alias("old_start"),
        )
    )
    silence = epoch_seconds(F.col("first_event")) - epoch_seconds(F.col("last_utc"))
    goes_on = F.coalesce(silence < gap_seconds, F.lit(False))
    return (
        first_events.join(open_sessions(earlier, border, gap_seconds), "user_id", "left")
        .withColumn("new_start", F.when(goes_on, F.col("first_utc")).otherwise(F.col("first_event")))
        .where("old_start <> new_start")
        .select("user_id", "old_start", "new_start")
    )


def _under_old_start(rows: DataFrame, moved: DataFrame, how: str) -> DataFrame:
    named = moved.withColumnRenamed("old_start", "session_start_utc")
    return rows.join(named, ["user_id", "session_start_utc"], how)


def _renamed(rows: DataFrame, moved: DataFrame) -> DataFrame:
    """All rows, those of moved sessions with their new start and id."""
    start = F.coalesce("new_start", "session_start_utc")
    changed: dict[str, Column] = {
        "session_id": session_id_of(F.col("user_id"), start),
        "session_start_utc": start,
    }
    return _under_old_start(rows, moved, "left").withColumns(changed).select(*schemas.SILVER.names)


def repair_after(
    spark: SparkSession,
    lake: Lake,
    after: str | dt.date,
    gap_seconds: int = GAP_SECONDS,
    run_id: str | None = None,
    zone: str = LOCAL_ZONE,
) -> list[dt.date]:
    """Makes the days after ``after`` agree with those up to it and returns the days that were
    written. Silver must have been consistent before the range that ends there was ingested
    again. Pass the days on to ``refresh_gold_weeks``."""
    last, reach = as_date(after), _reach(gap_seconds)
    require_utc_session(spark)
    with recorded_run(
        spark, lake.audit_path, run_id, lake.silver.path, lake.silver.path, last, None
    ) as run:
        create_silver(spark, lake)
        later = sorted(d for d in known_days(spark, lake.silver, schemas.SILVER_DAY) if d > last)
        silver = read_silver(spark, lake.silver.name)
        moved = moved_starts(silver, last, gap_seconds, zone)
        near = [d for d in later if d <= last + reach]
        written: list[dt.date] = []
        if near and not moved.isEmpty():
            far = _days_reached(silver, moved, [d for d in later if d > near[-1]], last + reach, reach)
            for days in (far, _with_rows(silver, moved, near)):
                if days:
                    rows = silver.where(F.col(schemas.SILVER_DAY).isin(days))
                    write_silver(spark, lake, _renamed(rows, moved))
                    written += days
        run.row_count = len(written)
        run.wrote(sorted(written))
    return sorted(written)


def _with_rows(silver: DataFrame, moved: DataFrame, days: list[dt.date]) -> list[dt.date]:
    """Those of the days that have rows of moved sessions."""
    rows = silver.where(F.col(schemas.SILVER_DAY).isin(days)).select(
        "user_id", "session_start_utc", schemas.SILVER_DAY
    )
    found = _under_old_start(rows, moved, "left_semi").select(schemas.SILVER_DAY).distinct().collect()
    return sorted(row[0] for row in found)


def _days_reached(
    silver: DataFrame, moved: DataFrame, days: list[dt.date], seen: dt.date, reach: dt.timedelta
) -> list[dt.date]:
    """The days beyond ``seen`` that moved sessions run into. Looks at twice as many days each
    turn, until a session's longest silence has passed without one."""
    found: list[dt.date] = []
    active, span = seen, reach
    while days and days[0] <= active + reach:
        turn = [d for d in days if d <= active + max(span, reach)]
        days = days[len(turn) :]
        hit = _with_rows(silver, moved, turn)
        found += hit
        if not hit:
            break
        active, span = hit[-1], span * 2
    return found


def reingest(
    spark: SparkSession,
    lake: Lake,
    start: str | dt.date,
    end: str | dt.date,
    gap_seconds: int = GAP_SECONDS,
    run_id: str | None = None,
    zone: str = LOCAL_ZONE,
    time_format: str | None = None,
) -> tuple[Ingested, list[dt.date]]:
    """``ingest_onward`` of a range that Bronze has more, or fewer, rows for now, and the repair
    of the days after it: equal to a run over everything. Returns what the range got and the
    later days that were written too. Days of the range that lost all their rows are dropped."""
    done = ingest_onward(
        spark, lake, start, end, gap_seconds, run_id, zone, time_format, drop_empty_days=True
    )
    return done, repair_after(spark, lake, end, gap_seconds, run_id and f"{run_id}-after", zone)
