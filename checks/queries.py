"""Registered queries: (spark, sf_dir) -> DataFrame, each over the whole table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from checks import raw_events as given
from checks.scratch import drop_lake, scratch_dir, scratch_lake, stored
from tideline import schemas
from tideline.functions.clock import day_literal
from tideline.operators import activity, sessions, steps
from tideline.operators import cleaning
from tideline.operators.cleaning import with_utc_day
from tideline.operators.ranges import days_between
from tideline.plans import activity_state, audit, bronze, gold, repair, silver
from tideline.plans.lake import Lake
from tideline.sinks import known_days, repair_partitions, replace_days
from tideline.sources import read_bronze, read_bronze_range, read_raw_csv
from tideline.streaming import (
    closed_sessions,
    read_closed_sessions,
    read_raw_stream,
    store_closed_sessions,
    stream_into_lake,
)

HALF_HOUR = 1800
DAY = 86_400

# The range that range queries ask for, in local days.
RANGE = (dt.date(2024, 1, 10), dt.date(2024, 1, 20))
# The day from which sessions are carried on.
ONWARD_FROM = dt.date(2024, 1, 16)
# Most files of an arrival; streams take 1,000 at a time, so one micro-batch has it whole.
ARRIVAL_FILES = 500
# Events to each task that holds open sessions of a stream; no more sessions can be open.
STATE_EVENTS = 250_000

Query = Callable[[SparkSession, str], DataFrame]


# --- raw and Bronze ---------------------------------------------------------------


def _as_csv(raw: DataFrame, folder: str) -> str:
    raw.write.option("header", True).csv(folder)
    return folder


def csv_scan(spark, sf_dir):
    raw = given.raw_events(spark, sf_dir).select(*schemas.RAW.names, "event_id")
    folder = _as_csv(raw, f"{scratch_dir(spark)}/csv")
    keyed = T.StructType([*schemas.RAW.fields, T.StructField("event_id", T.LongType())])
    return read_raw_csv(spark, folder, schema=keyed).withColumn(
        "price", F.col("price").cast("double")
    )


def raw_events_view(spark, sf_dir):
    given.raw_events(spark, sf_dir).createOrReplaceTempView("raw_events")
    counted = spark.sql(
        "SELECT event_type, brand, count(*) AS rows FROM raw_events "
        "GROUP BY event_type, brand"
    )
    spark.catalog.dropTempView("raw_events")
    return counted


def bronze_partition_date(spark, sf_dir):
    return with_utc_day(given.raw_events(spark, sf_dir)).select(
        "event_id", "event_time", schemas.BRONZE_DAY
    )


def _bronze_lake(spark, sf_dir, user_buckets: int = 0, versioned_silver: bool = False) -> Lake:
    lake = scratch_lake(spark, user_buckets, versioned_silver)
    raw = given.raw_events(spark, sf_dir).select(*schemas.RAW.names)
    bronze.store_bronze(spark, lake, raw, source=f"{sf_dir}/events.parquet")
    return lake


def _rows_by(df: DataFrame, day: str) -> DataFrame:
    return df.groupBy(day).agg(F.count(F.lit(1)).alias("rows"))


def _settled(spark, lake: Lake, result: DataFrame) -> DataFrame:
    kept = stored(spark, result, f"{scratch_dir(spark)}/result")
    drop_lake(spark, lake)
    return kept


def bronze_roundtrip(spark, sf_dir):
    lake = scratch_lake(spark)
    raw = given.raw_events(spark, sf_dir).select(*schemas.RAW.names)
    bronze.build_bronze(spark, lake, _as_csv(raw, f"{scratch_dir(spark)}/csv"))
    return _settled(spark, lake, _priced(spark.table(lake.bronze.name)))


def _priced(bronze_rows: DataFrame) -> DataFrame:
    """Prices as numbers, since engines write the same number differently."""
    return bronze_rows.withColumn("price", F.col("price").cast("double"))


def bronze_incremental(spark, sf_dir):
    """Two loads that both hold bad times and share a day; the second one comes twice."""
    lake, folder = scratch_lake(spark), scratch_dir(spark)
    raw, time = given.raw_events(spark, sf_dir), F.col("event_time")
    early = F.when(time == "not-a-time", F.col("event_id") % 2 == 0).otherwise(
        time < "2024-01-10 12"
    )
    for key, part in (("early", early), ("late", ~early), ("late", ~early)):
        csv = f"{folder}/{key}"
        if key == "early" or not _holds(spark, csv):
            _as_csv(raw.filter(part).select(*schemas.RAW.names), csv)
        bronze.add_csv_load(spark, lake, csv, key)
    stored_rows = read_bronze(spark, lake.bronze_loads.name)
    return _settled(spark, lake, _priced(stored_rows))


def bronze_ledger(spark, sf_dir):
    """Three folders of files that share all days: one comes as a load before the full build,
    one only with it, one as a load after it. Each is sent again in other ways."""
    lake, folder = scratch_lake(spark), scratch_dir(spark)
    raw, key = given.raw_events(spark, sf_dir), F.col("event_id")
    a, b, c = (
        _as_csv(raw.filter(key % 3 == n).select(*schemas.RAW.names), f"{folder}/{n}") for n in range(3)
    )
    bronze.add_csv_load(spark, lake, a, "a")
    bronze.build_bronze(spark, lake, [a, b])
    bronze.add_csv_load(spark, lake, [b, c], "c")
    bronze.add_csv_load(spark, lake, [a, c], "again")
    bronze.build_bronze(spark, lake, [a, b, c])
    bronze.add_csv_load(spark, lake, [a, b], "a")
    stored_rows = read_bronze(spark, lake.bronze.name, lake.bronze_loads.name)
    return _settled(spark, lake, _priced(stored_rows))


def _holds(spark, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def bronze_range_scan(spark, sf_dir):
    lake = _bronze_lake(spark, sf_dir)
    rows = read_bronze_range(spark, lake.bronze.name, *RANGE, buffer_days=2)
    return _settled(spark, lake, _rows_by(rows, schemas.BRONZE_DAY))


# --- cleaning and the session steps -----------------------------------------------


def typed_events(spark, sf_dir):
    return given.typed(spark, sf_dir)


def typed_events_strict(spark, sf_dir):
    """Only one form of time is read."""
    return cleaning.typed_events(given.raw_events(spark, sf_dir), "yyyy-MM-dd HH:mm:ss")


def clean_events_kst(spark, sf_dir):
    return given.clean(spark, sf_dir).select(
        "event_id", "event_time_utc", "event_time_kst", schemas.SILVER_DAY
    )


def previous_event(spark, sf_dir):
    return steps.with_previous_event(given.exact_clean(spark, sf_dir), "event_id").select(
        "event_id", "prev_event_time_utc"
    )


def previous_event_heavy(spark, sf_dir):
    return steps.with_previous_event(given.heavy_clean(spark, sf_dir), "event_id").select(
        "event_id", "prev_event_time_utc"
    )


def session_flags(spark, sf_dir):
    return steps.with_session_flag(
        given.exact_clean(spark, sf_dir), "event_id", HALF_HOUR
    ).select("event_id", "is_new_session")


def session_numbers(spark, sf_dir):
    return steps.with_session_number(given.exact_clean(spark, sf_dir), HALF_HOUR).select(
        "event_id", "session_seq"
    )


def session_starts(spark, sf_dir):
    return steps.with_session_start(given.exact_clean(spark, sf_dir), HALF_HOUR).select(
        "event_id", "session_start_utc"
    )


# --- sessions ---------------------------------------------------------------------


def sessionize(spark, sf_dir):
    return sessions.sessionize(given.clean(spark, sf_dir))


def sessionize_30m(spark, sf_dir):
    return sessions.sessionize(given.clean(spark, sf_dir), HALF_HOUR)


def _keyed_sessions(clean: DataFrame, gap: int) -> DataFrame:
    return (
        sessions.with_sessions(clean, gap)
        .withColumn(
            "session_id",
            sessions.session_id_of(F.col("user_id"), F.col("session_start_utc")),
        )
        .select(
            "event_id", "user_id", "session_id", "session_start_utc", schemas.SILVER_DAY
        )
    )


def sessionize_subsecond(spark, sf_dir):
    return _keyed_sessions(given.exact_clean(spark, sf_dir), sessions.GAP_SECONDS)


def sessionize_subsecond_30m(spark, sf_dir):
    return _keyed_sessions(given.exact_clean(spark, sf_dir), HALF_HOUR)


def sessionize_heavy(spark, sf_dir):
    return _keyed_sessions(given.heavy_clean(spark, sf_dir), HALF_HOUR)


def sessionize_gap1(spark, sf_dir):
    """The same at a gap of one second, where buckets are as many as seconds."""
    return _keyed_sessions(given.heavy_clean(spark, sf_dir), 1)


def session_numbers_gap1(spark, sf_dir):
    numbered = steps.with_session_number(given.heavy_clean(spark, sf_dir), 1)
    return numbered.select("event_id", "session_seq")


def session_window_sessions(spark, sf_dir):
    return sessions.session_summary(given.exact_clean(spark, sf_dir), HALF_HOUR)


def sessionize_range(spark, sf_dir):
    buffered = days_between(
        with_utc_day(given.raw_events(spark, sf_dir)),
        schemas.BRONZE_DAY,
        *RANGE,
        buffer_days=2,
    ).drop(schemas.BRONZE_DAY)
    return silver.silver_range(buffered, *RANGE, gap_seconds=DAY)


def sessionize_carry(spark, sf_dir):
    """Days from ``ONWARD_FROM`` on, continuing sessions as long as they ever ran."""
    clean, day = given.clean(spark, sf_dir), F.col(schemas.SILVER_DAY)
    earlier = sessions.sessionize(clean.filter(day < day_literal(ONWARD_FROM)), DAY)
    midnight_utc = F.to_utc_timestamp(
        day_literal(ONWARD_FROM).cast("timestamp"), "Asia/Seoul"
    )
    still_open = sessions.open_sessions(earlier, midnight_utc, DAY)
    new = clean.filter(day >= day_literal(ONWARD_FROM))
    return sessions.sessionize_from(new, still_open, DAY)


# --- Silver tables ----------------------------------------------------------------


def _local_days(spark, lake: Lake) -> tuple[dt.date, dt.date]:
    """First and last local day that stored Bronze rows can fall on."""
    days = known_days(spark, lake.bronze, schemas.BRONZE_DAY)
    return min(days), max(days) + dt.timedelta(days=1)


def _silver_lake(spark, sf_dir, gap: int = HALF_HOUR) -> Lake:
    lake = _bronze_lake(spark, sf_dir)
    silver.ingest(spark, lake, *_local_days(spark, lake), gap_seconds=gap)
    return lake


def silver_rerun_idempotent(spark, sf_dir):
    lake = _silver_lake(spark, sf_dir)
    silver.ingest(spark, lake, *_local_days(spark, lake), gap_seconds=HALF_HOUR)
    return _settled(spark, lake, spark.table(lake.silver.name))


def silver_no_buffer(spark, sf_dir):
    """No look-back asked for: all rows of the local days are there all the same."""
    lake = _bronze_lake(spark, sf_dir)
    silver.ingest(spark, lake, *RANGE, gap_seconds=HALF_HOUR, buffer_days=0)
    return _settled(spark, lake, spark.table(lake.silver.name))


def silver_partial_overwrite(spark, sf_dir):
    """One day is stored again with its views only; all others must stay."""
    lake = _silver_lake(spark, sf_dir)
    day = RANGE[0]
    views = (
        given.clean(spark, sf_dir)
        .filter(F.col(schemas.SILVER_DAY) == day_literal(day))
        .filter(F.col("event_type") == "view")
    )
    replace_days(
        sessions.sessionize(views, HALF_HOUR).select(*schemas.SILVER.names),
        lake.silver.path,
        schemas.SILVER_DAY,
    )
    repair_partitions(spark, lake.silver)
    return _settled(spark, lake, spark.table(lake.silver.name))


def silver_empty_batch(spark, sf_dir):
    """A range without events is ingested on top; nothing may change."""
    lake = _silver_lake(spark, sf_dir)
    _, last = _local_days(spark, lake)
    later = last + dt.timedelta(days=30)
    silver.ingest(spark, lake, later, later, gap_seconds=HALF_HOUR)
    return _settled(spark, lake, spark.table(lake.silver.name))


def silver_onward_weekly(spark, sf_dir):
    """The whole table, ingested week after week, each going on from the last."""
    lake = _bronze_lake(spark, sf_dir)
    first, last = _local_days(spark, lake)
    while first <= last:
        end = min(first + dt.timedelta(days=6), last)
        silver.ingest_onward(spark, lake, first, end, gap_seconds=DAY)
        first = end + dt.timedelta(days=1)
    rows = spark.table(lake.silver.name).select(
        "user_id",
        "event_time_utc",
        "event_type",
        "session_id",
        "session_start_utc",
        schemas.SILVER_DAY,
    )
    return _settled(spark, lake, rows)


def silver_clustered(spark, sf_dir):
    """Silver in four files by user a day, its second half going on from its first."""
    lake = _bronze_lake(spark, sf_dir, user_buckets=4)
    first, last = _local_days(spark, lake)
    for start, end in ((first, ONWARD_FROM), (ONWARD_FROM + dt.timedelta(days=1), last)):
        silver.ingest_onward(spark, lake, start, end, gap_seconds=DAY)
    return _settled(spark, lake, spark.table(lake.silver.name))


def silver_published(spark, sf_dir):
    """Silver of the first days, then of all days, each published at once; read through a
    catalog that has only the journal to go by."""
    lake = _bronze_lake(spark, sf_dir, versioned_silver=True)
    first, last = _local_days(spark, lake)
    for end in (ONWARD_FROM, last):
        silver.ingest_onward(spark, lake, first, end, gap_seconds=DAY)
    spark.sql(f"DROP TABLE {lake.silver.name}")
    silver.create_silver(spark, lake)
    return _settled(spark, lake, spark.table(lake.silver.name))


def silver_late_day(spark, sf_dir):
    """Half the rows of a day in the middle come after all days were ingested. Sessions of a
    day's gap run through many of the days after it."""
    lake = scratch_lake(spark)
    raw = given.raw_events(spark, sf_dir)
    event_time = F.to_timestamp(F.substring("event_time", 1, 19), "yyyy-MM-dd HH:mm:ss")
    local = F.when(F.col("event_time") != "not-a-time", F.to_date(event_time + F.expr("INTERVAL 9 HOURS")))
    late = F.coalesce((local == day_literal(ONWARD_FROM)) & (F.col("event_id") % 2 == 0), F.lit(False))
    bronze.store_bronze(spark, lake, raw.filter(~late).select(*schemas.RAW.names))
    silver.ingest_onward(spark, lake, *_local_days(spark, lake), gap_seconds=DAY)
    bronze.add_load(spark, lake, raw.filter(late).select(*schemas.RAW.names), "late")
    repair.reingest(spark, lake, ONWARD_FROM, ONWARD_FROM, gap_seconds=DAY)
    return _settled(spark, lake, spark.table(lake.silver.name))


def external_table_silver(spark, sf_dir):
    """Silver through the catalog, after its table was dropped and created anew."""
    lake = _silver_lake(spark, sf_dir)
    spark.sql(f"DROP TABLE {lake.silver.name}")
    silver.create_silver(spark, lake)
    return _settled(spark, lake, spark.table(lake.silver.name))


# --- streams ----------------------------------------------------------------------


def _arriving(spark, sf_dir) -> list[DataFrame]:
    """The raw rows in four arrivals, by time but for every seventh row, which comes an arrival
    late. The table is read once; an arrival has as many files as its rows have splits, up to
    what a micro-batch takes in."""
    raw = given.raw_events(spark, sf_dir)
    at, late = F.to_date(F.substring("event_time", 1, 10), "yyyy-MM-dd"), F.col("event_id") % 7 == 0
    day = F.when(F.col("event_time") == "not-a-time", 1).otherwise(F.dayofmonth(at))
    turn = F.least(F.floor((day - 1) / 8) + late.cast("int"), F.lit(3)).cast("int")
    dealt = raw.select(*schemas.RAW.names, turn.alias("turn"))
    folder = f"{scratch_dir(spark)}/dealt"
    dealt.write.partitionBy("turn").parquet(folder)
    rows = spark.read.schema(dealt.schema).parquet(folder)
    return [
        rows.where(F.col("turn") == n).select(*schemas.RAW.names).coalesce(ARRIVAL_FILES) for n in range(4)
    ]


def _drained(start: Callable[[], StreamingQuery], parts: list[DataFrame], folder: str) -> None:
    """Lets the arrivals come one by one, each followed by a run of the stream over what is new."""
    for part in parts:
        part.write.mode("append").option("header", True).csv(folder)
        start().awaitTermination()


def _state_tasks(spark: SparkSession, events: int) -> int:
    return max(spark.sparkContext.defaultParallelism, -(-events // STATE_EVENTS))


def stream_sessions(spark, sf_dir):
    """Sessions given out by a stream with late rows; one event of a far day closes the rest."""
    folder = scratch_dir(spark)
    end = [("2030-01-01 00:00:00 UTC", "end", None, None, None, None, None, "-1", None)]
    parts = [*_arriving(spark, sf_dir), spark.createDataFrame(end, schemas.RAW)]
    tasks = _state_tasks(spark, given.table(spark, sf_dir).count())

    def start():
        found = closed_sessions(read_raw_stream(spark, f"{folder}/csv"), "12 days", HALF_HOUR)
        return store_closed_sessions(found, f"{folder}/sessions", f"{folder}/checkpoint", tasks)

    _drained(start, parts, f"{folder}/csv")
    return read_closed_sessions(spark, f"{folder}/sessions")


def stream_silver(spark, sf_dir):
    """All layers, kept up to date with files as they arrive."""
    lake, folder = scratch_lake(spark), scratch_dir(spark)

    def start():
        return stream_into_lake(spark, lake, f"{folder}/csv", f"{folder}/checkpoint", HALF_HOUR)

    _drained(start, _arriving(spark, sf_dir), f"{folder}/csv")
    return _settled(spark, lake, spark.table(lake.silver.name))


# --- weekly activity --------------------------------------------------------------


def wau_by_user(spark, sf_dir):
    # Users need no sessions: the clean rows are the Silver rows.
    return activity.users_by_week(given.clean(spark, sf_dir))


def wau_by_session(spark, sf_dir):
    return activity.sessions_by_week(sessionize(spark, sf_dir))


def wau_across_weeks(spark, sf_dir):
    """Day-long gap: many sessions lie in two weeks and count in both."""
    return activity.sessions_by_week(
        sessions.sessionize(given.clean(spark, sf_dir), DAY)
    )


def wau_top200(spark, sf_dir):
    return activity.top_weeks(activity.weekly_activity(sessionize(spark, sf_dir)), 200)


def wau_gold(spark, sf_dir):
    lake = _silver_lake(spark, sf_dir)
    gold.build_gold(spark, lake)
    return _settled(spark, lake, gold.build_gold(spark, lake))


def wau_report(spark, sf_dir):
    lake = _silver_lake(spark, sf_dir)
    users, found_sessions = gold.activity_report(spark, lake)
    return _settled(spark, lake, users.join(found_sessions, schemas.GOLD_WEEK))


def wau_incremental(spark, sf_dir):
    """A full build over half of the days; then the other half, whose weeks alone are
    recounted, and a range without events, which changes nothing."""
    lake = _bronze_lake(spark, sf_dir)
    first, last = _local_days(spark, lake)
    middle = first + (last - first) // 2
    silver.ingest(spark, lake, first, middle, gap_seconds=HALF_HOUR)
    gold.build_gold(spark, lake)
    for start, end in ((middle, last), (last + dt.timedelta(days=40),) * 2):
        done = silver.ingest(
            spark, lake, start + dt.timedelta(days=1), end + dt.timedelta(days=1), HALF_HOUR
        )
        weekly = gold.refresh_gold_weeks(spark, lake, done.written_days)
    return _settled(spark, lake, weekly)


def _state_lake(spark, sf_dir) -> Lake:
    """Silver of a day's gap and its state, in two halves of the days; then a day in the middle
    of each half is refreshed once more."""
    lake = _bronze_lake(spark, sf_dir)
    first, last = _local_days(spark, lake)
    middle = first + (last - first) // 2
    for start, end in ((first, middle), (middle + dt.timedelta(days=1), last)):
        done = silver.ingest_onward(spark, lake, start, end, gap_seconds=DAY)
        activity_state.refresh_state(spark, lake, done.written_days, gap_seconds=DAY)
    again = [first + (middle - first) // 2, ONWARD_FROM]
    activity_state.refresh_state(spark, lake, again, gap_seconds=DAY)
    return lake


def wau_from_state(spark, sf_dir):
    lake = _state_lake(spark, sf_dir)
    return _settled(spark, lake, activity_state.weekly_from_state(spark, lake))


def activity_by_third(spark, sf_dir):
    """Spans that are no weeks: the days 1 to 10, 11 to 20 and 21 on of each month."""
    lake = _state_lake(spark, sf_dir)
    day = F.col(schemas.SILVER_DAY)
    tens = F.least(F.floor((F.dayofmonth(day) - 1) / 10), F.lit(2)).cast("int")
    third = F.date_add(F.trunc(day, "month"), tens * 10)
    spans = activity_state.activity_by(spark, lake, third, "first_day")
    return _settled(spark, lake, spans)


def activity_of_range(spark, sf_dir):
    lake = _state_lake(spark, sf_dir)
    return _settled(spark, lake, activity_state.activity_between(spark, lake, *RANGE))


# --- run records ------------------------------------------------------------------


def run_audit_latest(spark, sf_dir):
    lake = scratch_lake(spark)
    raw = given.raw_events(spark, sf_dir).select(*schemas.RAW.names)
    bronze.store_bronze(spark, lake, raw, run_id="bronze")
    days = _local_days(spark, lake)
    silver.ingest(spark, lake, *days, gap_seconds=HALF_HOUR, run_id="silver")
    gold.build_gold(spark, lake, run_id="gold")
    latest = audit.latest_status(audit.read_audit(spark, lake.audit_path))
    return _settled(spark, lake, latest.select("run_id", "status", "row_count"))


def run_audit_days(spark, sf_dir):
    """Days a run had no rows on, of those it was asked for: a range that goes on past the
    last event."""
    lake = _bronze_lake(spark, sf_dir)
    first, last = _local_days(spark, lake)
    silver.ingest(spark, lake, first, last, gap_seconds=HALF_HOUR, run_id="all")
    end = last + dt.timedelta(days=3)
    silver.ingest(spark, lake, last, end, gap_seconds=HALF_HOUR, run_id="past the end")
    latest = audit.latest_status(audit.read_audit(spark, lake.audit_path))
    missed = audit.days_without_rows(latest.where("run_id in ('all', 'past the end')"))
    return _settled(spark, lake, missed.select("run_id", F.col("day").cast("date").alias("day")))


def lost_values(spark, sf_dir):
    """What a build could not keep of its raw values, as its run record has it."""
    lake = scratch_lake(spark)
    raw = given.raw_events(spark, sf_dir).select(*schemas.RAW.names)
    bronze.store_bronze(spark, lake, raw, run_id="bronze")
    latest = audit.latest_status(audit.read_audit(spark, lake.audit_path))
    counts = latest.select(F.explode("lost_values").alias("lost", "rows"))
    return _settled(spark, lake, counts)


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        csv_scan,
        raw_events_view,
        bronze_partition_date,
        bronze_roundtrip,
        bronze_incremental,
        bronze_ledger,
        bronze_range_scan,
        typed_events,
        typed_events_strict,
        clean_events_kst,
        previous_event,
        previous_event_heavy,
        session_flags,
        session_numbers,
        session_starts,
        sessionize,
        sessionize_30m,
        sessionize_subsecond,
        sessionize_subsecond_30m,
        sessionize_heavy,
        sessionize_gap1,
        session_numbers_gap1,
        session_window_sessions,
        sessionize_range,
        sessionize_carry,
        silver_rerun_idempotent,
        silver_no_buffer,
        silver_partial_overwrite,
        silver_empty_batch,
        silver_onward_weekly,
        silver_clustered,
        silver_published,
        silver_late_day,
        external_table_silver,
        stream_sessions,
        stream_silver,
        wau_by_user,
        wau_by_session,
        wau_across_weeks,
        wau_top200,
        wau_gold,
        wau_report,
        wau_incremental,
        wau_from_state,
        activity_by_third,
        activity_of_range,
        run_audit_latest,
        run_audit_days,
        lost_values,
    )
}
