"""Distinct counts of any span of days from a small state of each day, exact.

Users. Each has a number from a dictionary, and a day's users are bitmaps of these numbers, one
row for each 32,768 numbers. The users of a span are the bits of its days' bitmaps put
together by `or`, so a user on several days counts once.

Sessions. A session is active on a few days that follow each other, so it needs no bit of its own:
a day's state is how many of its sessions were last active on which day before, if any. In a
span each session counts on its first active day there, which is the one whose day before lies
outside.

Neither needs the events again, and days can be replaced one by one.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline import schemas
from tideline.functions.clock import checked_range, day_literal

# Fixed value: numbers in one bitmap, by Spark's bitmap functions.
BITMAP = 32_768


def numbered(users: DataFrame, offsets: DataFrame) -> DataFrame:
    """(user_id, number) of staged users (user_id, place): a place is a partition's number and
    a row's in it, as `monotonically_increasing_id` gives, and `offsets` (part, before) has how
    many users stand before each partition. Numbers are dense without gathering the users."""
    part = F.shiftright("place", 33)
    row = F.col("place").bitwiseAND(F.lit(2**33 - 1))
    placed = users.withColumn("part", part).join(offsets, "part")
    return placed.select("user_id", (F.col("before") + row + 1).alias("number"))


def user_bitmaps(silver: DataFrame, numbers: DataFrame) -> DataFrame:
    """(event_date_kst, bucket, users) of each day of Silver. Days and users are made distinct
    before they are joined with their numbers."""
    seen = silver.select(schemas.SILVER_DAY, "user_id").distinct()
    number = F.col("number")
    return (
        seen.join(numbers, "user_id")
        .groupBy(schemas.SILVER_DAY, F.bitmap_bucket_number(number).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("users"))
    )


def session_days(silver: DataFrame) -> DataFrame:
    """(event_date_kst, day_before, sessions): how many of a day's sessions were last active on
    `day_before` (null: on none). Needs Silver as far back as a session can be silent.

    A window a session holds a row for each of its days.
    """
    by_session = Window.partitionBy("session_id").orderBy(schemas.SILVER_DAY)
    return (
        silver.select("session_id", schemas.SILVER_DAY)
        .distinct()
        .withColumn("day_before", F.lag(schemas.SILVER_DAY).over(by_session))
        .groupBy(schemas.SILVER_DAY, "day_before")
        .agg(F.count(F.lit(1)).alias("sessions"))
    )


def users_by_span(bitmaps: DataFrame, span: Column, name: str) -> DataFrame:
    """Distinct users of each span, `span` being the first day of a day's span."""
    return (
        bitmaps.groupBy(span.alias(name), "bucket")
        .agg(F.bitmap_or_agg("users").alias("users"))
        .groupBy(name)
        .agg(F.sum(F.bitmap_count("users")).alias("wau_by_user"))
    )


def sessions_by_span(days: DataFrame, span: Column, name: str) -> DataFrame:
    """Distinct sessions of each span."""
    first = F.col("day_before").isNull() | (F.col("day_before") < F.col(name))
    return (
        days.withColumn(name, span)
        .groupBy(name)
        .agg(F.sum(F.when(first, F.col("sessions")).otherwise(0)).alias("wau_by_session"))
    )


def activity_by_span(bitmaps: DataFrame, days: DataFrame, span: Column, name: str) -> DataFrame:
    users, sessions = users_by_span(bitmaps, span, name), sessions_by_span(days, span, name)
    return users.join(sessions, name)


def activity_between(
    bitmaps: DataFrame, days: DataFrame, start: str | dt.date, end: str | dt.date
) -> DataFrame:
    """One row: distinct users and sessions of the days from ``start`` to ``end``."""
    first, last = checked_range(start, end)
    inside = F.col(schemas.SILVER_DAY).between(day_literal(first), day_literal(last))
    users = bitmaps.where(inside).groupBy("bucket").agg(F.bitmap_or_agg("users").alias("users"))
    new = F.col("day_before").isNull() | (F.col("day_before") < day_literal(first))
    none = F.lit(0).cast("long")
    counts = users.select(F.bitmap_count("users").alias("users"), none.alias("sessions")).unionByName(
        days.where(inside & new).select(none.alias("users"), "sessions")
    )
    return counts.agg(*[F.coalesce(F.sum(c), none).alias(c) for c in ("users", "sessions")])
