"""The steps of the session cut as columns on every event.

``sessionize`` does not need these; they are for looking at a cut in detail. Events of
a user are ordered by time, event type, product and last the caller's row key, which
has to be unique so that equal rows have an order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline.functions import epoch_seconds
from tideline.operators.sessions import (
    GAP_SECONDS,
    check_gap,
    with_sessions,
)

MINUTE_US = 60 * 1_000_000


def _minute(instant_utc: Column) -> Column:
    """The instant's minute. Clean events always have one; saying so keeps the planner
    from testing this join key for null by computing it again."""
    micros = F.unix_micros(instant_utc)
    return F.coalesce(micros - F.pmod(micros, F.lit(MINUTE_US)), F.lit(0))


def with_previous_event(clean: DataFrame, row_key: str) -> DataFrame:
    """Adds ``prev_event_time_utc``: time of the user's event before this one.

    Equal to ``lag`` over the user's rows, without a window over full rows:

    1. (user, instant) groups, combined before the shuffle, with the first row of each;
    2. ``lag`` over a minute's distinct instants, and for the first one of a minute the last
       instant of the user's minute before, by a window over one row a minute (525,600
       a year and user at most);
    3. one equi-join of full rows on (user, instant), which adaptive execution can split.

    Rows that share an instant follow each other, so only its first row looks further back.
    """
    among_ties = F.struct("event_type", "product_id", row_key)
    minute = _minute(F.col("event_time_utc"))
    in_minute = Window.partitionBy("user_id", "minute").orderBy("event_time_utc")
    instants = (
        clean.groupBy("user_id", "event_time_utc")
        .agg(F.min(among_ties).alias("first_row"))
        .withColumn("minute", minute)
        .withColumn("near_utc", F.lag("event_time_utc").over(in_minute))
    )
    per_user = Window.partitionBy("user_id").orderBy("minute")
    minutes = (
        clean.groupBy("user_id", minute.alias("minute"))
        .agg(F.max("event_time_utc").alias("last_utc"))
        .select("user_id", "minute", F.lag("last_utc").over(per_user).alias("far_utc"))
    )
    earlier = instants.join(minutes, ["user_id", "minute"]).select(
        "user_id", "event_time_utc", "first_row", F.coalesce("near_utc", "far_utc").alias("earlier_utc")
    )
    opens = among_ties == F.col("first_row")
    return (
        clean.join(earlier, ["user_id", "event_time_utc"])
        .withColumn(
            "prev_event_time_utc",
            F.when(opens, F.col("earlier_utc")).otherwise(F.col("event_time_utc")),
        )
        .drop("first_row", "earlier_utc")
    )


def starts_session(
    instant_utc: Column, previous_utc: Column, gap_seconds: int = GAP_SECONDS
) -> Column:
    """1 for a user's first event or after a silence of ``gap`` seconds, else 0."""
    silence = epoch_seconds(instant_utc) - epoch_seconds(previous_utc)
    return F.when(
        previous_utc.isNull() | (silence >= check_gap(gap_seconds)), 1
    ).otherwise(0)


def with_session_flag(
    clean: DataFrame, row_key: str, gap_seconds: int = GAP_SECONDS
) -> DataFrame:
    return with_previous_event(clean, row_key).withColumn(
        "is_new_session",
        starts_session(
            F.col("event_time_utc"), F.col("prev_event_time_utc"), gap_seconds
        ),
    )


def with_session_number(
    clean: DataFrame, gap_seconds: int = GAP_SECONDS
) -> DataFrame:
    """Adds ``session_seq``, the session's ordinal among the user's, from 1."""
    return with_sessions(clean, gap_seconds).drop("session_start_utc")


def with_session_start(clean: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Adds ``session_start_utc``, the time of the session's first event."""
    return with_sessions(clean, gap_seconds).drop("session_seq")
