"""Counts from the daily state against counts from Silver."""

import datetime as dt
import random
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from test_repair import events, OCT, HOUR
from tideline import schemas
from tideline.operators import activity, distincts
from tideline.plans import activity_state, bronze, repair, silver
from tideline.plans.lake import Lake


@pytest.fixture()
def lake(spark):
    made = Lake.under(tempfile.mkdtemp(prefix="run-", dir="/tmp"), f"t_{uuid.uuid4().hex}")
    yield made
    spark.sql(f"DROP DATABASE IF EXISTS `{made.silver.database}` CASCADE")


def from_silver(spark, lake, start, end):
    day = F.col(schemas.SILVER_DAY)
    rows = spark.table(lake.silver.name).where(day.between(F.lit(start), F.lit(end)))
    return tuple(rows.agg(F.count_distinct("user_id"), F.count_distinct("session_id")).first())


@pytest.mark.parametrize("hours", [2, 24, 70])
def test_any_span_after_any_change_of_days(spark, lake, hours):
    draw, gap = random.Random(hours), hours * HOUR
    rows = [(draw.choice([0, 0, 1, 2, 3, 4]), round(draw.uniform(0, 24 * 12), 2)) for _ in range(150)]
    late = [r for r in rows if 24 * 5 <= r[1] < 24 * 6]
    bronze.store_bronze(spark, lake, events(spark, [r for r in rows if r not in late]))
    for start, end in ((1, 4), (5, 12)):
        done = silver.ingest_onward(spark, lake, OCT(start), OCT(end), gap)
        activity_state.refresh_state(spark, lake, done.written_days, gap)

    def check():
        for _ in range(6):
            a, b = sorted(draw.choices(range(1, 13), k=2))
            got = activity_state.activity_between(spark, lake, OCT(a), OCT(b)).first()
            assert tuple(got) == from_silver(spark, lake, OCT(a), OCT(b))
        want = activity.weekly_activity(spark.table(lake.silver.name)).orderBy(schemas.GOLD_WEEK).collect()
        assert activity_state.weekly_from_state(spark, lake).collect() == want

    check()
    for more in (late, []):  # a day comes with more rows, and then loses them
        bronze.add_load(spark, lake, events(spark, more), "late")
        done, repaired = repair.reingest(spark, lake, OCT(6), OCT(6), gap)
        days = [*done.written_days, *done.empty_days, *repaired]
        activity_state.refresh_state(spark, lake, days, gap)
        check()


def test_numbers_are_dense_and_stay(spark, lake):
    bronze.store_bronze(spark, lake, events(spark, [(u, 1 + u % 40) for u in range(300)]))
    silver.ingest(spark, lake, OCT(1), OCT(1))
    activity_state.refresh_state(spark, lake, [OCT(1)])
    once = {r.user_id: r.number for r in spark.table(lake.user_numbers.name).collect()}
    silver.ingest(spark, lake, OCT(2), OCT(2))
    assert activity_state.refresh_state(spark, lake, [OCT(2)]) == [OCT(2)]
    all_numbers = {r.user_id: r.number for r in spark.table(lake.user_numbers.name).collect()}
    assert sorted(all_numbers.values()) == list(range(1, 301))
    assert once.items() <= all_numbers.items() and len(once) < 300


def test_users_beyond_one_bitmap(spark):
    n = 3 * distincts.BITMAP
    users = spark.range(0, 2 * n, 1, 7).select(
        (F.col("id") % n).alias("user_id"),
        F.date_add(F.lit(dt.date(2019, 10, 1)), (F.col("id") % 5).cast("int")).alias(schemas.SILVER_DAY),
    )
    numbers = spark.range(n).select(F.col("id").alias("user_id"), (F.col("id") + 1).alias("number"))
    bitmaps = distincts.user_bitmaps(users, numbers)
    counted = distincts.users_by_span(bitmaps, F.lit(dt.date(2019, 10, 1)), "span").collect()
    assert [r.wau_by_user for r in counted] == [n]
    assert bitmaps.count() == 5 * 3


def test_an_empty_lake(spark, lake):
    assert activity_state.refresh_state(spark, lake, []) == []
    assert activity_state.weekly_from_state(spark, lake).collect() == []
    assert tuple(activity_state.activity_between(spark, lake, OCT(1), OCT(9)).first()) == (0, 0)


def test_counting_does_not_read_silver(spark, lake):
    bronze.store_bronze(spark, lake, events(spark, [(1, 1)]))
    silver.ingest(spark, lake, OCT(1), OCT(1))
    activity_state.refresh_state(spark, lake, [OCT(1)])
    text = activity_state.weekly_from_state(spark, lake)._jdf.queryExecution().executedPlan().toString()
    assert "silver_events" not in text and "partial_bitmap_or_agg" in text
