"""Sessions of a stream of raw events, each given out once it can no longer change."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from tideline import schemas
from tideline.functions.clock import LOCAL_ZONE, kst_wall_clock, require_utc_session
from tideline.operators.cleaning import clean_events, typed_events
from tideline.operators.sessions import GAP_SECONDS, check_gap
from tideline.sinks import replace_load

SHUFFLE_TASKS = "spark.sql.shuffle.partitions"
# The folder of a micro-batch, by its number.
BATCH = "batch"
CLOSED = T.StructType(
    [
        T.StructField("user_id", T.LongType(), True),
        T.StructField("session_start_utc", T.TimestampType(), True),
        T.StructField("session_end_utc", T.TimestampType(), True),
        T.StructField("events", T.LongType(), True),
        T.StructField(BATCH, T.LongType(), True),
        T.StructField(schemas.SILVER_DAY, T.DateType(), True),
    ]
)


def read_raw_stream(
    spark: SparkSession, path: str, header: bool = True, files_a_batch: int = 1000
) -> DataFrame:
    """Raw events from CSV files as they come into a folder, read as ``read_raw_csv`` does."""
    return (
        spark.readStream.schema(schemas.RAW)
        .option("header", header)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .option("maxFilesPerTrigger", files_a_batch)
        .csv(path)
    )


def closed_sessions(
    raw: DataFrame,
    late_by: str,
    gap_seconds: int = GAP_SECONDS,
    zone: str = LOCAL_ZONE,
    time_format: str | None = None,
) -> DataFrame:
    """(user_id, session_start_utc, session_end_utc, events, event_date_kst) of sessions in a stream.

    A session is given out when no event that is at most ``late_by`` behind the latest one
    can touch it any more; later events are dropped. So for events no later than that the
    result equals a batch over all of them, but for the sessions still open.

    Silences count whole seconds, and a session ends where one reaches the gap: windows reach
    half a second less than the gap past an event's whole second, since ``session_window``
    joins windows that touch. Duplicates count as events, as in a batch.
    """
    reach = f"{check_gap(gap_seconds) * 1000 - 500} milliseconds"
    clean = clean_events(typed_events(raw, time_format), zone)
    whole = F.date_trunc("second", "event_time_utc")
    return (
        clean.select("user_id", "event_time_utc", whole.alias("whole_utc"))
        .withWatermark("whole_utc", late_by)
        .groupBy("user_id", F.session_window("whole_utc", reach).alias("window"))
        .agg(
            F.min("event_time_utc").alias("session_start_utc"),
            F.max("event_time_utc").alias("session_end_utc"),
            F.count(F.lit(1)).alias("events"),
        )
        .select(
            "user_id",
            "session_start_utc",
            "session_end_utc",
            "events",
            F.to_date(kst_wall_clock(F.col("session_start_utc"), zone)).alias(schemas.SILVER_DAY),
        )
    )


@contextmanager
def _shuffled_into(spark: SparkSession, tasks: int | None) -> Iterator[None]:
    """A stream that is started within keeps this number, or the session's, for its shuffles."""
    before = spark.conf.get(SHUFFLE_TASKS)
    spark.conf.set(SHUFFLE_TASKS, tasks or before)
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_TASKS, before)


def store_closed_sessions(
    sessions: DataFrame, path: str, checkpoint: str, state_tasks: int | None = None
) -> StreamingQuery:
    """Writes what has arrived, in micro-batches, and stops; the next call goes on from there.

    A micro-batch has a folder of its own, by day within it, and replaces it when it is run
    again after a failure: each session is stored once. ``checkpoint`` and ``path`` are
    shared folders.

    Open sessions are dealt to ``state_tasks`` tasks (without it, the session's number for
    shuffles) by the first call; the checkpoint keeps its number. A stream's plan is not adaptive:
    in every micro-batch each of them loads and stores its state, however little that is, and
    writes a file a day. So they are best sized to the sessions open at a time.
    """
    require_utc_session(sessions.sparkSession)

    def store(rows: DataFrame, number: int) -> None:
        replace_load(rows, f"{path}/{BATCH}={number}", schemas.SILVER_DAY)

    with _shuffled_into(sessions.sparkSession, state_tasks):
        return (
            sessions.writeStream.outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .foreachBatch(store)
            .start()
        )


def read_closed_sessions(spark: SparkSession, path: str) -> DataFrame:
    """All sessions stored so far."""
    return spark.read.schema(CLOSED).parquet(path).drop(BATCH)
