"""Silver -> a small state of each day, from which any span of days is counted exactly.

The state is three tables: numbers of users, which only grow, users of each day as bitmaps,
and sessions of each day by the day they were last active on before. A day that was written again
replaces its own state and that of the days in which its sessions can go on. Counting reads
the state alone.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tideline import schemas
from tideline.functions.clock import require_utc_session
from tideline.operators import distincts
from tideline.operators.sessions import GAP_SECONDS, check_gap
from tideline.plans.audit import recorded_run
from tideline.plans.lake import Lake
from tideline.plans.silver import DAY_SECONDS, create_silver
from tideline.sinks import (
    LayerTable,
    create_layer_table,
    empty_folder,
    known_days,
    register_days,
    register_partitions,
    replace_days,
)
from tideline.sources import read_silver


def create_state(spark: SparkSession, lake: Lake) -> None:
    create_layer_table(spark, lake.user_numbers, schemas.USER_NUMBERS, schemas.NUMBERS_BATCH)
    create_layer_table(spark, lake.user_days, schemas.USER_DAYS, schemas.SILVER_DAY)
    create_layer_table(spark, lake.session_days, schemas.SESSION_DAYS, schemas.SILVER_DAY)


def refresh_state(
    spark: SparkSession,
    lake: Lake,
    days: Iterable[dt.date],
    gap_seconds: int = GAP_SECONDS,
    run_id: str | None = None,
) -> list[dt.date]:
    """Brings the state of the days up to date with Silver, and that of the days after them in
    which their sessions can go on. Pass the days an ingest wrote, dropped or repaired. Only
    one refresh may run at a time, since it gives out numbers."""
    require_utc_session(spark)
    given = set(days)
    reach = dt.timedelta(days=1 + check_gap(gap_seconds) // DAY_SECONDS)
    with recorded_run(
        spark, lake.audit_path, run_id, lake.silver.path, lake.user_days.path
    ) as run:
        create_silver(spark, lake)
        create_state(spark, lake)
        known = known_days(spark, lake.silver, schemas.SILVER_DAY)
        touched = sorted(given | {d for d in known if any(g < d <= g + reach for g in given)})
        if touched:
            silver, day = read_silver(spark, lake.silver.name), F.col(schemas.SILVER_DAY)
            of_days = silver.where(day.isin(sorted(given)))
            _number_users(spark, lake, of_days)
            bitmaps = distincts.user_bitmaps(of_days, spark.table(lake.user_numbers.name))
            _replace(spark, lake.user_days, bitmaps, schemas.USER_DAYS, sorted(given))
            earlier = {t - dt.timedelta(days=n) for t in touched for n in range(reach.days + 1)}
            counted = distincts.session_days(silver.where(day.isin(sorted(earlier & known))))
            counted = counted.where(day.isin(touched))
            _replace(spark, lake.session_days, counted, schemas.SESSION_DAYS, touched)
        run.row_count = len(touched)
    return touched


def _number_users(spark: SparkSession, lake: Lake, silver: DataFrame) -> None:
    """Numbers users that have none yet. They are staged with their places first, so that a
    task run again numbers them alike."""
    table, batch = lake.user_numbers, uuid.uuid4().hex
    numbers = spark.table(table.name)
    new = silver.select("user_id").distinct().join(numbers, "user_id", "left_anti")
    staged_at = f"{table.path}_staged/{batch}"
    new.select("user_id", F.monotonically_increasing_id().alias("place")).write.parquet(staged_at)
    staged = spark.read.schema("user_id long, place long").parquet(staged_at)
    part = F.shiftright("place", 33).alias("part")
    before, offsets = numbers.agg(F.coalesce(F.max("number"), F.lit(0))).first()[0], []
    for row in staged.groupBy(part).count().orderBy("part").collect():  # a row a task
        offsets.append((row["part"], before))
        before += row["count"]
    if offsets:
        rows = distincts.numbered(staged, spark.createDataFrame(offsets, "part long, before long"))
        rows.write.parquet(f"{table.path}/{schemas.NUMBERS_BATCH}={batch}")
        register_partitions(spark, table, [{schemas.NUMBERS_BATCH: batch}])


def _replace(
    spark: SparkSession, table: LayerTable, rows: DataFrame, schema, days: list[dt.date]
) -> None:
    """Replaces these days; those without rows are left empty."""
    seen = Observation(table.table)
    replace_days(
        rows.select(*schema.names),
        table.path,
        schemas.SILVER_DAY,
        observation=seen,
        metrics=(F.collect_set(schemas.SILVER_DAY).alias("days"),),
    )
    own = schema.__class__([f for f in schema.fields if f.name != schemas.SILVER_DAY])
    for day in set(days) - set(seen.get.get("days") or []):
        empty_folder(spark, own, f"{table.path}/{schemas.SILVER_DAY}={day.isoformat()}")
    register_days(spark, table, schemas.SILVER_DAY, days)


def weekly_from_state(spark: SparkSession, lake: Lake) -> DataFrame:
    """Gold's rows of all weeks, without reading Silver."""
    week = F.date_trunc("week", schemas.SILVER_DAY).cast("date")
    counted = activity_by(spark, lake, week, schemas.GOLD_WEEK)
    return counted.select(*schemas.GOLD.names).orderBy(schemas.GOLD_WEEK)


def activity_by(spark: SparkSession, lake: Lake, span, name: str) -> DataFrame:
    """Users and sessions of each span of days: `span` gives a day's span by its first day,
    such as `trunc(day, 'month')`."""
    create_state(spark, lake)
    users, sessions = spark.table(lake.user_days.name), spark.table(lake.session_days.name)
    return distincts.activity_by_span(users, sessions, span, name)


def activity_between(
    spark: SparkSession, lake: Lake, start: str | dt.date, end: str | dt.date
) -> DataFrame:
    """One row: users and sessions of the days from ``start`` to ``end``."""
    create_state(spark, lake)
    users, sessions = spark.table(lake.user_days.name), spark.table(lake.session_days.name)
    return distincts.activity_between(users, sessions, start, end)
