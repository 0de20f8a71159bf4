"""Streams over files against batches over all of them."""

import inspect
import random
import tempfile
import uuid
from collections import Counter
from pathlib import Path

import pytest

from checks import queries, raw_events
from test_repair import HOUR, events
from tideline import schemas
from tideline.operators import activity, sessions
from tideline.operators.cleaning import clean_events, typed_events
from tideline.plans import activity_state, audit, gold
from tideline.plans.lake import Lake
from tideline.streaming import closed_sessions, read_closed_sessions, read_raw_stream
from tideline.streaming import store_closed_sessions, stream_into_lake
from tideline.streaming import arrivals, sessions as stream_sessions


@pytest.fixture()
def folder():
    return Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


@pytest.fixture()
def lake(spark, folder):
    made = Lake.under(f"{folder}/lake", f"t_{uuid.uuid4().hex}")
    yield made
    spark.sql(f"DROP DATABASE IF EXISTS `{made.silver.database}` CASCADE")


def send(raw, folder):
    raw.coalesce(1).write.mode("append").option("header", True).csv(f"{folder}/csv")


def batch_sessions(raw, gap):
    cut = sessions.session_summary(clean_events(typed_events(raw)), gap)
    return sorted((r.user_id, r.session_start_utc, r.events) for r in cut.collect())


def stored(spark, folder):
    rows = read_closed_sessions(spark, f"{folder}/sessions").collect()
    return sorted((r.user_id, r.session_start_utc, r.events) for r in rows)


@pytest.mark.parametrize("gap", [300, HOUR])
def test_closed_sessions_equal_a_batch(spark, folder, gap):
    """Silences of gap - 1, gap and gap + 1 seconds, sub-seconds, duplicates, rows up to a day
    late, and a user with a third of all."""
    draw, rows, at = random.Random(gap), [], 0.0
    for _ in range(240):
        at += draw.choice([0, 1, gap - 1, gap, gap + 1, draw.uniform(0, 3 * gap)]) + draw.choice([0, 0, 0.4])
        rows += [(draw.choice([7, 7, 1, 2]), at / HOUR)] * draw.choice([1, 1, 2])
    closing = [(-1, 24 * 1000)]
    parts = [[], [], []]
    for n, row in enumerate(rows):
        turn = min(2, n * 3 // len(rows) + (draw.random() < 0.2 and row[1] / rows[-1][1] % 1 > 0.5))
        parts[turn].append(row)
    late = f"{int(rows[-1][1]) + 1} hours"
    # Micro-batches come from separate runs, one of which is started twice.
    for part in [*parts, closing]:
        send(events(spark, part), folder)
        for _ in range(2 if part is parts[1] else 1):
            found = closed_sessions(read_raw_stream(spark, f"{folder}/csv"), late, gap)
            store_closed_sessions(found, f"{folder}/sessions", f"{folder}/check").awaitTermination()
    assert stored(spark, folder) == batch_sessions(events(spark, rows), gap)


def test_open_sessions_wait_and_too_late_rows_are_dropped(spark, folder):
    def run(*rows):
        send(events(spark, rows), folder)
        found = closed_sessions(read_raw_stream(spark, f"{folder}/csv"), "1 hour", 1800)
        store_closed_sessions(found, f"{folder}/sessions", f"{folder}/check").awaitTermination()
        return [(u, n) for u, _, n in stored(spark, folder)]

    assert run((1, 1), (1, 1.2), (2, 3)) == [(1, 2)]
    assert run((1, 0.9), (2, 3.4), (3, 9)) == [(1, 2), (2, 2)]
    assert run((4, 30), (3, 8.6)) == [(1, 2), (2, 2), (3, 2)]


def test_a_micro_batch_run_again_is_stored_once(spark, folder, monkeypatch):
    send(events(spark, [(1, 1), (2, 1), (-1, 900)]), folder)
    plain, failing = stream_sessions.replace_load, []

    def once(*args, **more):
        plain(*args, **more)
        if not failing:
            failing.append(1)
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(stream_sessions, "replace_load", once)
    run = lambda: store_closed_sessions(
        closed_sessions(read_raw_stream(spark, f"{folder}/csv"), "1 hour"), f"{folder}/sessions", f"{folder}/check")
    with pytest.raises(Exception, match="lost after the write"):
        run().awaitTermination()
    run().awaitTermination()
    assert [(u, n) for u, _, n in stored(spark, folder)] == [(1, 1), (2, 1)]


def test_all_layers_follow_the_files(spark, lake, folder, monkeypatch):
    """Files in any order of time, an event that joins days long done, and a run that fails."""
    draw = random.Random(4)
    rows = [(draw.choice([0, 0, 1, 2]), round(draw.uniform(0, 24 * 9), 2)) for _ in range(80)]
    gap, parts = 20 * HOUR, [rows[n::3] for n in range(3)]
    run = lambda: stream_into_lake(spark, lake, f"{folder}/csv", f"{folder}/check", gap)
    plain = arrivals.refresh_gold_weeks
    for n, part in enumerate(parts):
        send(events(spark, part), folder)
        if n == 1:
            with monkeypatch.context() as patch:
                patch.setattr(arrivals, "refresh_gold_weeks", None)
                with pytest.raises(Exception):
                    run().awaitTermination()
        assert arrivals.refresh_gold_weeks is plain
        run().awaitTermination()
    whole = sessions.sessionize(clean_events(typed_events(events(spark, rows))), gap)
    want = whole.select(*schemas.SILVER.names)
    have = spark.table(lake.silver.name)
    assert have.exceptAll(want).count() == 0 and want.exceptAll(have).count() == 0
    weekly = activity.weekly_activity(want).orderBy(schemas.GOLD_WEEK).collect()
    assert gold.read_gold(spark, lake.gold.name).collect() == weekly
    assert activity_state.weekly_from_state(spark, lake).collect() == weekly
    latest = audit.latest_status(audit.read_audit(spark, lake.audit_path))
    assert latest.where("status <> 'SUCCESS'").count() == 0
    run().awaitTermination()  # nothing new
    assert spark.table(lake.silver.name).count() == len(rows)


def test_arrivals_are_written_by_many_tasks(spark, folder, monkeypatch):
    """A table of several files: an arrival is no single task's, and has no more files than allowed."""
    table = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    table.repartition(4).write.parquet(f"{folder}/sf/events.parquet")
    parts = queries._arriving(spark, f"{folder}/sf")
    assert [part.rdd.getNumPartitions() for part in parts] == [4] * 4
    have, want = [row for part in parts for row in part.collect()], raw_events.raw_events(spark, f"{folder}/sf")
    assert Counter(have) == Counter(want.select(*schemas.RAW.names).collect())
    monkeypatch.setattr(queries, "ARRIVAL_FILES", 2)
    assert [part.rdd.getNumPartitions() for part in queries._arriving(spark, f"{folder}/sf")] == [2] * 4


def test_a_micro_batch_takes_an_arrival_whole():
    """Else the first part of one would move the watermark past the late rows of the others."""
    for reader in (read_raw_stream, stream_into_lake):
        assert queries.ARRIVAL_FILES <= inspect.signature(reader).parameters["files_a_batch"].default


def test_state_is_dealt_to_tasks_by_its_size(spark, folder, monkeypatch):
    """Not to as many as the session shuffles into; and further runs keep the number of the first."""
    monkeypatch.setattr(queries, "STATE_EVENTS", 150)
    assert queries._state_tasks(spark, 901) == 7
    assert queries._state_tasks(spark, 0) == spark.sparkContext.defaultParallelism
    number, seen = spark.conf.get("spark.sql.shuffle.partitions"), []
    for tasks, row in ((7, (1, 1)), (9, (-1, 900))):
        send(events(spark, [row]), folder)
        found = closed_sessions(read_raw_stream(spark, f"{folder}/csv"), "1 hour")
        run = store_closed_sessions(found, f"{folder}/sessions", f"{folder}/check", tasks)
        assert spark.conf.get("spark.sql.shuffle.partitions") == number
        run.awaitTermination()
        seen += [state.numStateStoreInstances for batch in run.recentProgress for state in batch.stateOperators]
    assert set(seen) == {7}
    assert [(u, n) for u, _, n in stored(spark, folder)] == [(1, 1)]


def test_the_query_sizes_its_state(spark, monkeypatch):
    given, plain = [], queries.store_closed_sessions
    monkeypatch.setattr(queries, "STATE_EVENTS", 150)

    def store(found, path, checkpoint, state_tasks=None):
        given.append(state_tasks)
        return plain(found, path, checkpoint, state_tasks)

    monkeypatch.setattr(queries, "store_closed_sessions", store)
    events_of = spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    queries.stream_sessions(spark, "/root/testdata/sf0.001")
    assert given == [max(spark.sparkContext.defaultParallelism, -(-events_of // 150))] * 5
