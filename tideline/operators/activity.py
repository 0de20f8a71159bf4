"""Weekly active users and sessions, exact, by local day."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tideline import schemas
from tideline.functions import week_start

def users_by_week(silver: DataFrame) -> DataFrame:
    """Distinct users per Monday week; ``week_start_date`` is a TIMESTAMP."""
    return _distinct_by_week(silver, "user_id", "wau_by_user")


def sessions_by_week(silver: DataFrame) -> DataFrame:
    """Distinct sessions per week of their events: one across two weeks counts twice."""
    return _distinct_by_week(silver, "session_id", "wau_by_session")


def _distinct_by_week(silver: DataFrame, key: str, name: str) -> DataFrame:
    week = week_start(F.col(schemas.SILVER_DAY))
    return (
        silver.groupBy(week.alias(schemas.GOLD_WEEK))
        .agg(F.count_distinct(key).alias(name))
        .orderBy(schemas.GOLD_WEEK)
    )


def weekly_activity(silver: DataFrame) -> DataFrame:
    """Gold rows: both counts per week, ``week_start_date`` as a DATE.

    Spark makes (week, user) and (week, session) distinct before and after a shuffle on
    all of them, and only then gathers by week, so the few weeks are no hot keys.
    """
    week = week_start(F.col(schemas.SILVER_DAY)).cast("date")
    return silver.groupBy(week.alias(schemas.GOLD_WEEK)).agg(
        F.count_distinct("user_id").alias("wau_by_user"),
        F.count_distinct("session_id").alias("wau_by_session"),
    )


def top_weeks(weekly: DataFrame, rows: int) -> DataFrame:
    """The first ``rows`` weeks."""
    return weekly.orderBy(schemas.GOLD_WEEK).limit(rows)
