"""Silver -> Gold: weekly activity, and the reports over it.

Gold's files lie in a folder a week. A full build replaces all folders; a refresh writes only
those of its weeks and reads no others, so refreshes of different weeks may run at once.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tideline import schemas
from tideline.functions.clock import day_literal, require_utc_session
from tideline.operators.activity import (
    sessions_by_week,
    users_by_week,
    weekly_activity,
)
from tideline.plans.audit import recorded_run
from tideline.plans.lake import Lake
from tideline.plans.silver import create_silver
from tideline.sinks import create_layer_table, empty_folder, replace_days, replace_load
from tideline.sources import read_gold, read_silver

# Fixed value: rows a printed report shows at most.
REPORT_ROWS = 200


def activity_report(spark: SparkSession, lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Weekly users and weekly sessions straight from Silver, first weeks first."""
    require_utc_session(spark)
    create_silver(spark, lake)
    silver = read_silver(spark, lake.silver.name)
    return users_by_week(silver), sessions_by_week(silver)


def build_gold(spark: SparkSession, lake: Lake, run_id: str | None = None) -> DataFrame:
    """Recounts every week, replaces Gold and returns it in week order."""
    require_utc_session(spark)
    with recorded_run(
        spark, lake.audit_path, run_id, lake.silver.path, lake.gold.path
    ) as run:
        create_silver(spark, lake)
        create_gold(spark, lake)
        weekly = weekly_activity(read_silver(spark, lake.silver.name))
        replace_load(_by_folder(weekly), lake.gold.path, schemas.GOLD_FOLDER)
        spark.catalog.refreshTable(lake.gold.name)
        gold = read_gold(spark, lake.gold.name)
        run.row_count = gold.count()
    return gold


def create_gold(spark: SparkSession, lake: Lake) -> None:
    create_layer_table(spark, lake.gold, schemas.GOLD, any_folder=True)


def _by_folder(weekly: DataFrame) -> DataFrame:
    return weekly.select(*schemas.GOLD.names).withColumn(schemas.GOLD_FOLDER, F.col(schemas.GOLD_WEEK))


def monday_of(day: dt.date) -> dt.date:
    return day - dt.timedelta(days=day.weekday())


def whole_weeks(silver: DataFrame, days: Iterable[dt.date]) -> DataFrame:
    """All Silver rows of the weeks that the days fall in; other days are not read."""
    weeks = sorted({monday_of(day) for day in days})
    if not weeks:
        return silver.limit(0)
    day = F.col(schemas.SILVER_DAY)
    return silver.filter(
        reduce(
            lambda some, more: some | more,
            [
                day.between(day_literal(w), day_literal(w + dt.timedelta(days=6)))
                for w in weeks
            ],
        )
    )


def refresh_gold_weeks(
    spark: SparkSession,
    lake: Lake,
    days: Iterable[dt.date],
    run_id: str | None = None,
) -> DataFrame:
    """Recounts only the weeks of the given days in Gold and returns all weeks.

    Each of these weeks is counted over all its days, so the result equals a full
    recount. Pass the days an ingest wrote, or dropped; no days change nothing. Weeks that
    have no rows any more are emptied. Other weeks are neither read nor written.
    """
    days = list(days)
    require_utc_session(spark)
    with recorded_run(
        spark, lake.audit_path, run_id, lake.silver.path, lake.gold.path
    ) as run:
        create_silver(spark, lake)
        create_gold(spark, lake)
        if days:
            touched = whole_weeks(read_silver(spark, lake.silver.name), days)
            seen = Observation("gold")
            replace_days(
                _by_folder(weekly_activity(touched)),
                lake.gold.path,
                schemas.GOLD_FOLDER,
                observation=seen,
                metrics=(F.collect_set(schemas.GOLD_WEEK).alias("weeks"),),
            )
            for week in {monday_of(day) for day in days} - set(seen.get.get("weeks") or []):
                folder = f"{lake.gold.path}/{schemas.GOLD_FOLDER}={week.isoformat()}"
                empty_folder(spark, schemas.GOLD, folder)
            spark.catalog.refreshTable(lake.gold.name)
        gold = read_gold(spark, lake.gold.name)
        run.row_count = gold.count()
    return gold


def show_report(report: DataFrame, title: str, rows: int = REPORT_ROWS) -> None:
    """Prints the first rows; only the printing is bounded."""
    print(title)
    report.show(rows, truncate=False)
