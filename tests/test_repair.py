"""A range that is ingested again, and the days after it, against a run over everything."""

import datetime as dt
import random
import tempfile
import uuid
from pathlib import Path

import pytest

from test_sessions import raw_rows
from tideline import schemas
from tideline.operators import sessions
from tideline.operators.cleaning import clean_events, typed_events
from tideline.plans import bronze, gold, repair, silver
from tideline.plans.lake import Lake

HOUR = 3600


@pytest.fixture(params=[0, 3], ids=["by day", "clustered"])
def lake(spark, request):
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    made = Lake.under(root, f"t_{uuid.uuid4().hex}", user_buckets=request.param)
    yield made
    spark.sql(f"DROP DATABASE IF EXISTS `{made.silver.database}` CASCADE")


def events(spark, rows):
    """Raw rows of (user, hours after local midnight of 1 October)."""
    day = dt.datetime(2019, 9, 30, 15)
    stamp = lambda h: f"{day + dt.timedelta(hours=h):%Y-%m-%d %H:%M:%S} UTC"
    return raw_rows(spark, [(stamp(h), "view", "1", "1", str(u), None) for u, h in rows])


def ids(spark, lake):
    rows = spark.table(lake.silver.name).groupBy("user_id", "event_time_utc", "session_id", schemas.SILVER_DAY)
    return sorted(tuple(r) for r in rows.count().collect())


def full(spark, rows, gap):
    cut = sessions.sessionize(clean_events(typed_events(events(spark, rows))), gap)
    counted = cut.groupBy("user_id", "event_time_utc", "session_id", schemas.SILVER_DAY).count()
    return sorted(tuple(r) for r in counted.collect())


def folders(lake):
    return {p.name: min(f.stat().st_mtime_ns for f in p.glob("*.parquet"))
            for p in Path(lake.silver.path).glob(f"{schemas.SILVER_DAY}=*") if list(p.glob("*.parquet"))}


def days_written(before, after):
    return sorted(dt.date.fromisoformat(n.partition("=")[2]) for n in after if after[n] != before.get(n))


OCT = lambda d: dt.date(2019, 10, d)


def test_a_late_row_joins_two_sessions_and_only_their_days_are_written(spark, lake):
    early = [(1, 20), (1, 26), (1, 38), (1, 50), (1, 62), (2, 30), (2, 100), (3, 90)]
    gap = 13 * HOUR
    bronze.store_bronze(spark, lake, events(spark, [r for r in early if r != (1, 38)]))
    silver.ingest_onward(spark, lake, OCT(1), OCT(6), gap)
    assert ids(spark, lake) == full(spark, [r for r in early if r != (1, 38)], gap)
    bronze.add_load(spark, lake, events(spark, [(1, 38)]), "late")
    before = folders(lake)
    done, repaired = repair.reingest(spark, lake, OCT(2), OCT(2), gap)
    assert (done.written_days, repaired) == ([OCT(2)], [OCT(3)])
    assert days_written(before, folders(lake)) == [OCT(2), OCT(3)]
    assert ids(spark, lake) == full(spark, early, gap)
    assert repair.repair_after(spark, lake, OCT(2), gap) == []


def test_rows_that_go_split_a_session(spark, lake):
    rows = [(1, h) for h in range(0, 24 * 6, 5)] + [(2, 26), (2, 50)]
    gap, lost = 6 * HOUR, [(1, h) for h in range(25, 48, 5)]
    bronze.store_bronze(spark, lake, events(spark, [r for r in rows if r not in lost]))
    bronze.add_load(spark, lake, events(spark, lost), "part")
    silver.ingest_onward(spark, lake, OCT(1), OCT(6), gap)
    assert ids(spark, lake) == full(spark, rows, gap)
    gold.build_gold(spark, lake)
    bronze.add_load(spark, lake, events(spark, []), "part")
    done, repaired = repair.reingest(spark, lake, OCT(2), OCT(2), gap)
    assert repaired == [OCT(d) for d in (3, 4, 5, 6)]
    assert ids(spark, lake) == full(spark, [r for r in rows if r not in lost], gap)
    refreshed = gold.refresh_gold_weeks(spark, lake, [*done.written_days, *done.empty_days, *repaired])
    assert refreshed.collect() == gold.build_gold(spark, lake).collect()


@pytest.mark.parametrize("seed, hours", [(1, 7), (2, 24), (3, 60), (4, 25), (5, 100)])
def test_random_late_rows(spark, lake, seed, hours):
    """Gaps of under a day to several days, days without rows, a user with a third of all."""
    draw = random.Random(seed)
    rows = sorted({(draw.choice([0, 0, 1, 2, 3]), round(draw.uniform(0, 24 * 14), 2)) for _ in range(90)})
    start, end = OCT(5), OCT(5 + draw.randint(0, 2))
    inside = lambda h: start <= OCT(1 + int(h // 24)) <= end
    late = [r for r in rows if inside(r[1]) and draw.random() < 0.7]
    gap = hours * HOUR
    bronze.store_bronze(spark, lake, events(spark, [r for r in rows if r not in late]))
    silver.ingest_onward(spark, lake, OCT(1), OCT(15), gap)
    bronze.add_load(spark, lake, events(spark, late), "late")
    repair.reingest(spark, lake, start, end, gap)
    assert ids(spark, lake) == full(spark, rows, gap)
    bronze.add_load(spark, lake, events(spark, []), "late")
    repair.reingest(spark, lake, start, end, gap)
    assert ids(spark, lake) == full(spark, [r for r in rows if r not in late], gap)


def test_a_failed_repair_is_put_right_by_the_next(spark, lake, monkeypatch):
    rows = [(1, h) for h in range(0, 24 * 6, 5)]
    gap, late = 6 * HOUR, [(1, 30)]
    bronze.store_bronze(spark, lake, events(spark, [r for r in rows if r not in late]))
    silver.ingest_onward(spark, lake, OCT(1), OCT(6), gap)
    bronze.add_load(spark, lake, events(spark, late), "late")
    calls, plain = [], repair.write_silver

    def failing(*args, **more):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        plain(*args, **more)

    with monkeypatch.context() as patch:
        patch.setattr(repair, "write_silver", failing)
        with pytest.raises(RuntimeError):
            repair.reingest(spark, lake, OCT(2), OCT(2), gap)
    _, repaired = repair.reingest(spark, lake, OCT(2), OCT(2), gap)
    assert repaired == [OCT(3)]  # the days beyond were done before the failure
    assert ids(spark, lake) == full(spark, rows, gap)


def test_border_reads_three_columns_and_combines_before_the_shuffle(spark, lake):
    bronze.store_bronze(spark, lake, events(spark, [(1, 1), (1, 30)]))
    silver.ingest_onward(spark, lake, OCT(1), OCT(3))
    moved = repair.moved_starts(spark.table(lake.silver.name), OCT(1))
    text = moved._jdf.queryExecution().executedPlan().toString()
    assert text.count("partial_min") >= 1 and text.count("partial_max") >= 1
    assert "category" not in text
