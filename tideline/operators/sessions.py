"""Cutting each user's events into sessions.

A session ends where the next event of the user comes ``gap`` whole seconds later, or
more. Running a window over all rows of a user would put a heavy user into one task,
so the cut is made on time buckets instead of on rows:

1. Two events of a user in the same bucket of ``gap`` seconds are less than ``gap``
   apart, and so is every step between them: a bucket never holds a session cut.
   Grouping by (user, bucket) therefore loses nothing. It is combined before the
   shuffle, so a user with a third of all rows leaves a map task as a few rows.
2. The window per user runs over buckets. Their number is bounded by the time span
   divided by the gap (105,120 per user and year at 300 s), whatever the row count. Under
   a gap of ``WINDOW_GAP`` it would be large, and buckets are stitched in two levels: a window
   per user and span of ``SPAN`` buckets (a day at a gap of 1 s) cuts them as if the span
   stood alone; what a span does to the session that reaches it is one row (its first and
   last instant, how many sessions it has and the start of the last). Composing these rows
   is associative, so a window per user over spans tells each span whether its first
   session goes on from before, and since when.
3. Events take their session from an equi-join on (user, bucket), which has exactly
   one match per event. This is the only shuffle of full rows, and one that adaptive
   execution can split where a single (user, bucket) is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tideline import schemas
from tideline.functions import epoch_seconds

# Fixed value: the default silence that ends a session.
GAP_SECONDS = 300
# From this gap on, one window per user holds all its buckets; under it, spans of so many.
WINDOW_GAP, SPAN = 300, 86_400

_USER_BUCKET = ["user_id", "bucket"]


def check_gap(gap_seconds: int) -> int:
    if gap_seconds < 1:
        raise ValueError("the session gap must be at least one second")
    return gap_seconds


def bucket_of(instant_utc: Column, gap_seconds: int) -> Column:
    """First second of the gap-wide bucket that the instant falls in.

    Clean events always have one. Saying so keeps the planner from testing this join key
    for null, which it would do by parsing the raw time again for every row.
    """
    epoch = epoch_seconds(instant_utc)
    bucket = epoch - F.pmod(epoch, F.lit(check_gap(gap_seconds)))
    return F.coalesce(bucket, F.lit(0))


def session_id_of(user_id: Column, start_utc: Column) -> Column:
    return F.concat_ws(
        "_", user_id.cast("string"), epoch_seconds(start_utc).cast("string")
    )


def activity_buckets(events: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """One row per user and bucket: its first and last instant and its events."""
    return events.groupBy(
        "user_id", bucket_of(F.col("event_time_utc"), gap_seconds).alias("bucket")
    ).agg(
        F.min("event_time_utc").alias("first_utc"),
        F.max("event_time_utc").alias("last_utc"),
        F.count(F.lit(1)).alias("events"),
    )


def stitched_buckets(buckets: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Adds session number and session start to each bucket."""
    if check_gap(gap_seconds) >= WINDOW_GAP:
        return _cut_by(buckets, ["user_id"], gap_seconds)
    span = F.col("bucket") - F.pmod("bucket", F.lit(gap_seconds * SPAN))
    in_spans = _cut_by(buckets.withColumn("span", span), ["user_id", "span"], gap_seconds)
    goes_on = F.when(F.col("session_seq") == 1, F.col("open_since"))
    return in_spans.join(_before_spans(in_spans, gap_seconds), ["user_id", "span"]).select(
        *buckets.columns,
        (F.col("session_seq") + F.col("seq_before")).alias("session_seq"),
        F.coalesce(goes_on, F.col("session_start_utc")).alias("session_start_utc"),
    )


def _cut_by(buckets: DataFrame, keys: list[str], gap_seconds: int) -> DataFrame:
    """Session number and start of each bucket as if those of its keys were all there are."""
    by_time = Window.partitionBy(*keys).orderBy("first_utc")
    so_far = by_time.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    silence = epoch_seconds(F.col("first_utc")) - epoch_seconds(
        F.lag("last_utc").over(by_time)
    )
    opens = F.coalesce(silence >= gap_seconds, F.lit(True))
    return (
        buckets.withColumn("opens", opens)
        .withColumn("session_seq", F.sum(F.col("opens").cast("int")).over(so_far))
        .withColumn(
            "session_start_utc",
            F.max(F.when(F.col("opens"), F.col("first_utc"))).over(so_far),
        )
        .drop("opens")
    )


def _before_spans(in_spans: DataFrame, gap_seconds: int) -> DataFrame:
    """For each span the start of the session that goes on into it (null: none does), and how
    many sessions the user has before those that begin in it."""
    by_span = Window.partitionBy("user_id").orderBy("span")
    so_far = by_span.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    silence = epoch_seconds(F.col("first_utc")) - epoch_seconds(F.lag("last_utc").over(by_span))
    own_start = F.when(~F.col("goes_on") | (F.col("sessions") > 1), F.col("last_start"))
    begun = F.col("sessions") - F.col("goes_on").cast("int")
    return (
        in_spans.groupBy("user_id", "span")
        .agg(
            F.min("first_utc").alias("first_utc"),
            F.max("last_utc").alias("last_utc"),
            F.max("session_seq").alias("sessions"),
            F.max("session_start_utc").alias("last_start"),
        )
        .withColumn("goes_on", F.coalesce(silence < gap_seconds, F.lit(False)))
        .withColumn("open_at_end", F.last(own_start, ignorenulls=True).over(so_far))
        .withColumn("open_since", F.when(F.col("goes_on"), F.lag("open_at_end").over(by_span)))
        .withColumn("seq_before", F.sum(begun).over(so_far) - F.col("sessions"))
        .select("user_id", "span", "open_since", "seq_before")
    )


def assign_sessions(
    events: DataFrame, stitched: DataFrame, gap_seconds: int = GAP_SECONDS
) -> DataFrame:
    """Gives each event the session number and start of its bucket."""
    return (
        events.withColumn("bucket", bucket_of(F.col("event_time_utc"), gap_seconds))
        .join(
            stitched.select(*_USER_BUCKET, "session_seq", "session_start_utc"),
            _USER_BUCKET,
        )
        .drop("bucket")
    )


def with_sessions(clean: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Clean events plus ``session_seq`` and ``session_start_utc``; all rows kept."""
    stitched = stitched_buckets(activity_buckets(clean, gap_seconds), gap_seconds)
    return assign_sessions(clean, stitched, gap_seconds)


def silver_columns(sessionized: DataFrame) -> DataFrame:
    """The Silver columns in order, after any row key the caller carries along."""
    helper = {"session_seq", "session_id", *schemas.SILVER.names}
    others = [c for c in sessionized.columns if c not in helper]
    return sessionized.withColumn(
        "session_id", session_id_of(F.col("user_id"), F.col("session_start_utc"))
    ).select(*others, *schemas.SILVER.names)


def sessionize(clean: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """Clean events -> Silver rows."""
    return silver_columns(with_sessions(clean, gap_seconds))


def session_summary(clean: DataFrame, gap_seconds: int = GAP_SECONDS) -> DataFrame:
    """One row per session, by Spark's own session windows over the buckets.

    ``session_window`` joins neighbours that touch, so each bucket reaches half a
    second less than ``gap`` past its last whole second. It merges all windows of a user in
    one task; under ``WINDOW_GAP`` the buckets' own sessions are summed up instead.
    """
    if check_gap(gap_seconds) < WINDOW_GAP:
        stitched = stitched_buckets(activity_buckets(clean, gap_seconds), gap_seconds)
        summed = stitched.groupBy("user_id", "session_start_utc").agg(F.sum("events").alias("events"))
        return summed.select("user_id", "session_start_utc", "events")
    first, last = epoch_seconds(F.col("first_utc")), epoch_seconds(F.col("last_utc"))
    reach_ms = (last - first + check_gap(gap_seconds)) * 1000 - 500
    window = F.session_window(
        F.timestamp_seconds(first), F.concat(reach_ms.cast("string"), F.lit(" milliseconds"))
    )
    return (
        activity_buckets(clean, gap_seconds)
        .groupBy("user_id", window.alias("window"))
        .agg(
            F.min("first_utc").alias("session_start_utc"),
            F.sum("events").alias("events"),
        )
        .select("user_id", "session_start_utc", "events")
    )


def open_sessions(
    silver: DataFrame, boundary_utc: Column, gap_seconds: int = GAP_SECONDS
) -> DataFrame:
    """Sessions that an event at or after the boundary could still continue.

    One row per user: start and last instant of the user's latest session, if it ends
    within one gap before the boundary. Combined before the shuffle.
    """
    age = epoch_seconds(boundary_utc) - epoch_seconds(F.col("event_time_utc"))
    return (
        silver.filter(
            (F.col("event_time_utc") < boundary_utc) & (age < check_gap(gap_seconds))
        )
        .groupBy("user_id")
        .agg(
            F.max_by("session_start_utc", "event_time_utc").alias("first_utc"),
            F.max("event_time_utc").alias("last_utc"),
        )
    )


def sessionize_from(
    clean: DataFrame, still_open: DataFrame, gap_seconds: int = GAP_SECONDS
) -> DataFrame:
    """Silver rows of ``clean``, going on with sessions that are still open.

    Exact however long a session has been running, provided the open sessions are:
    each one enters the window as a bucket that stands before the user's new ones.
    """
    new = activity_buckets(clean, gap_seconds).withColumn("carried", F.lit(False))
    carried = still_open.select(
        "user_id",
        bucket_of(F.col("last_utc"), gap_seconds).alias("bucket"),
        "first_utc",
        "last_utc",
        F.lit(0).cast("bigint").alias("events"),
        F.lit(True).alias("carried"),
    )
    stitched = stitched_buckets(new.unionByName(carried), gap_seconds)
    return silver_columns(
        assign_sessions(clean, stitched.filter(~F.col("carried")), gap_seconds)
    )
