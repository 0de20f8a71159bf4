import datetime as dt
import random

import pytest
from pyspark.sql import Row, functions as F, types as T

from brute import cut
from tideline import schemas
from tideline.functions import parse_event_time
from tideline.operators import sessions, steps
from tideline.operators.cleaning import clean_events, typed_events

DAY0 = dt.datetime(2019, 10, 25)

CLEAN = T.StructType(
    [
        T.StructField("key", T.LongType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("at", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.LongType()),
    ]
)


def clean_rows(spark, rows):
    """rows: (key, user, time, type, product); all other columns are empty."""
    texts = [(k, u, t.isoformat(sep=" "), e, p) for k, u, t, e, p in rows]
    df = spark.createDataFrame(texts, CLEAN).select(
        "key", "user_id", F.col("at").cast("timestamp").alias("event_time_utc"),
        "event_type", "product_id",
        F.lit(None).cast("bigint").alias("category_id"),
        *[F.lit(None).cast("string").alias(c)
          for c in ("category_code", "brand", "source_user_session")],
        F.lit(None).cast("double").alias("price"),
    )
    return clean_events(df)


def raw_rows(spark, rows):
    """rows: (time text, type, product, price, user, source session)."""
    full = [(t, e, p, "1", None, None, price, u, s) for t, e, p, price, u, s in rows]
    return spark.createDataFrame(full, schemas.RAW)


def raw_day(spark, times, user):
    return raw_rows(spark, [(f"2021-03-14 {t} UTC", "view", "3", "2.0", user, None) for t in times])


def ids(raw, gap=300):
    out = sessions.sessionize(clean_events(typed_events(raw)), gap)
    assert out.columns == schemas.SILVER.names
    return out.groupBy("session_id").count().rdd.collectAsMap()


def test_long_silences_cut_and_short_ones_do_not(spark):
    raw = raw_day(spark, ("09:00:00", "09:03:20", "09:07:10", "11:30:00", "23:59:59"), "41")
    assert ids(raw) == {"41_1615712400": 3, "41_1615721400": 1, "41_1615766399": 1}


def test_the_source_session_plays_no_part(spark):
    rows = [("2021-03-14 06:00:00 UTC", "same"), ("2021-03-14 08:00:00 UTC", "same"),
            ("2021-03-14 08:01:00 UTC", "other")]
    raw = raw_rows(spark, [(t, "cart", "3", "2.0", "41", s) for t, s in rows])
    assert ids(raw) == {"41_1615701600": 1, "41_1615708800": 2}


def test_local_midnight_is_at_15_utc(spark):
    raw = raw_day(spark, ("14:59:59", "15:00:00"), "41")
    rows = sessions.sessionize(clean_events(typed_events(raw))).collect()
    assert sorted(r.event_date_kst for r in rows) == [dt.date(2021, 3, 14), dt.date(2021, 3, 15)]
    assert {r.session_id for r in rows} == {"41_1615733999"}


def test_gap_of_exactly_300_seconds_splits(spark):
    raw = raw_day(spark, ("14:00:00", "14:04:59", "14:09:59", "14:15:00"), "1")
    assert ids(raw) == {"1_1615730400": 2, "1_1615730999": 1, "1_1615731300": 1}


def test_seconds_are_cut_off_before_subtracting(spark):
    raw = raw_rows(spark, [
        (f"2019-10-25 {t} UTC", "view", "1", "1", u, None)
        for u, t in (("1", "00:00:00.900"), ("1", "00:05:00.100"),
                     ("2", "00:00:00.100"), ("2", "00:04:59.900"))
    ])
    assert ids(raw) == {"1_1571961600": 1, "1_1571961900": 1, "2_1571961600": 2}


def test_ties_and_duplicates_stay_in_one_session(spark):
    raw = raw_rows(spark, [
        ("2019-10-25 10:00:00 UTC", "view", p, "1", "1", None) for p in ("2", None, "1", "1", "1")
    ])
    assert ids(raw) == {"1_1571997600": 5}


def test_bad_rows(spark):
    good = "2019-10-25 10:00:00 UTC"
    raw = raw_rows(spark, [
        ("garbage", "view", "1", "1", "1", None), (None, "view", "1", "1", "1", None),
        (good, "view", "1", "1", "abc", None), (good, "view", "1", "1", None, None),
        (good, "view", "1.5", "x", "9", None), (good, "view", "1", "1", " 8 ", None),
    ])
    out = sessions.sessionize(clean_events(typed_events(raw)))
    got = {r.user_id: (r.product_id, r.price) for r in out.collect()}
    assert got == {9: (None, None), 8: (1, 1.0)}


def test_two_users_interleaved(spark):
    raw = raw_rows(spark, [
        (f"2019-10-25 {t} UTC", "view", "1", "1", u, None)
        for u, t in (("1", "10:00:00"), ("2", "10:01:00"), ("1", "10:04:00"), ("2", "10:07:00"))
    ])
    assert ids(raw) == {"1_1571997600": 2, "2_1571997660": 1, "2_1571998020": 1}


def test_empty_input(spark):
    out = sessions.sessionize(clean_events(typed_events(spark.createDataFrame([], schemas.RAW))))
    assert out.collect() == []
    assert [(f.name, f.dataType) for f in out.schema] == [
        (f.name, f.dataType) for f in schemas.SILVER
    ]


@pytest.mark.parametrize("text, expected", [
    ("2019-10-01 00:00:00 UTC", "2019-10-01 00:00:00"),
    ("2019-10-01 00:00:00", "2019-10-01 00:00:00"),
    ("2019-10-01", "2019-10-01 00:00:00"),
    ("2019-10-01 UTC", "2019-10-01 00:00:00"),
    ("2019-10-01 09:00:00 Asia/Seoul", "2019-10-01 00:00:00"),
    ("2019-10-01 00:00:00 UTC UTC", "2019-10-01 00:00:00"),
    (" UTC", None), ("not-a-time", None), ("", None), (None, None),
])
def test_event_time_forms(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(parse_event_time(F.col("t")).cast("string")).first()[0] == expected


def test_strict_format(spark):
    df = spark.createDataFrame([("2019-10-01 00:00:00 UTC",), ("2019-10-01",)], "t string")
    parsed = df.select(parse_event_time(F.col("t"), "yyyy-MM-dd HH:mm:ss").cast("string"))
    assert [r[0] for r in parsed.collect()] == ["2019-10-01 00:00:00", None]


def random_rows(seed, gap, users=12, per_user=120):
    """Distances around the gap, ties, duplicates, and one user with a third of all."""
    pick, rows, key = random.Random(seed), [], 0
    for user in range(users):
        at = DAY0 + dt.timedelta(microseconds=pick.randrange(10**9))
        for _ in range(per_user * (users // 2 if user == 0 else 1)):
            step = pick.choice([0, 0, 1, gap - 1, gap, gap + 1, pick.randrange(1, 3 * gap)])
            at += dt.timedelta(seconds=step, microseconds=pick.choice([0, 0, 999_999, 1]))
            rows.append((key, user, at, pick.choice(["view", "cart", None]),
                         pick.choice([1, 2, None])))
            key += 1
    pick.shuffle(rows)
    return rows


@pytest.mark.parametrize("gap", [1, 7, 300, 86_400])
def test_random_events_against_plain_python(spark, gap):
    rows = random_rows(gap, gap)
    want, clean = cut(rows, gap), clean_rows(spark, rows).cache()
    cut_rows = sessions.with_sessions(clean, gap).select("key", "session_seq", "session_start_utc")
    assert {r.key: (r.session_seq, r.session_start_utc) for r in cut_rows.collect()} == {
        k: v[2:] for k, v in want.items()
    }
    flagged = steps.with_session_flag(clean, "key", gap)
    assert {r.key: (r.prev_event_time_utc, r.is_new_session) for r in flagged.collect()} == {
        k: v[:2] for k, v in want.items()
    }
    summary = {(r.user_id, r.session_start_utc): r.events
               for r in sessions.session_summary(clean, gap).collect()}
    counted = {}
    for key, user, *_ in rows:
        at = (user, want[key][3])
        counted[at] = counted.get(at, 0) + 1
    assert summary == counted
    clean.unpersist()


@pytest.mark.parametrize("gap, span", [(1, 2), (1, 86_400), (7, 1), (300, 3), (86_400, 2)])
def test_stitching_spans_against_plain_python(spark, monkeypatch, gap, span):
    """Spans of few buckets: sessions that lie in one, end at its border, or run through many."""
    monkeypatch.setattr(sessions, "SPAN", span)
    monkeypatch.setattr(sessions, "WINDOW_GAP", 10**9)
    rows = random_rows(gap + span, gap)
    want, clean = cut(rows, gap), clean_rows(spark, rows).cache()
    cut_rows = sessions.with_sessions(clean, gap).select("key", "session_seq", "session_start_utc")
    assert {r.key: (r.session_seq, r.session_start_utc) for r in cut_rows.collect()} == {
        k: v[2:] for k, v in want.items()
    }
    counted = {}
    for key, user, *_ in rows:
        counted[user, want[key][3]] = counted.get((user, want[key][3]), 0) + 1
    summary = sessions.session_summary(clean, gap).collect()
    assert {(r.user_id, r.session_start_utc): r.events for r in summary} == counted

    boundary = F.lit(str(sorted(r[2] for r in rows)[len(rows) // 3])).cast("timestamp")
    full, later = sessions.sessionize(clean, gap), F.col("event_time_utc") >= boundary
    still_open = sessions.open_sessions(full, boundary, gap)
    onward = sessions.sessionize_from(clean.filter(later), still_open, gap)
    assert onward.exceptAll(full.filter(later)).count() == 0
    assert full.filter(later).exceptAll(onward).count() == 0
    clean.unpersist()


@pytest.mark.parametrize("gap", [300, 420, 86_400, 200_000])
def test_going_on_from_open_sessions_equals_full_run(spark, gap):
    rows = random_rows(gap + 1, gap, users=6, per_user=60)
    clean = clean_rows(spark, rows).cache()
    times = sorted(r[2] for r in rows)
    boundary = F.lit(str(times[len(times) // 3])).cast("timestamp")
    full = sessions.sessionize(clean, gap)
    still_open = sessions.open_sessions(full, boundary, gap)
    onward = sessions.sessionize_from(
        clean.filter(F.col("event_time_utc") >= boundary), still_open, gap
    )
    want = full.filter(F.col("event_time_utc") >= boundary)
    assert onward.exceptAll(want).count() == 0 and want.exceptAll(onward).count() == 0
    clean.unpersist()


def test_row_order_does_not_matter(spark):
    rows = random_rows(5, 300)
    one = sessions.sessionize(clean_rows(spark, rows)).drop("key")
    other = sessions.sessionize(clean_rows(spark, rows[::-1]).repartition(7)).drop("key")
    assert one.exceptAll(other).count() == 0 and other.exceptAll(one).count() == 0


@pytest.mark.parametrize("gap", [0, -5])
def test_gap_must_be_positive(spark, gap):
    with pytest.raises(ValueError):
        sessions.sessionize(clean_rows(spark, random_rows(1, 300, 2, 2)), gap)


def test_silver_row_values(spark):
    raw = raw_rows(spark, [("2019-10-25 15:16:00 UTC", "cart", "4", "2.5", "7", "src")])
    row = sessions.sessionize(clean_events(typed_events(raw))).first()
    assert row == Row(
        event_time_utc=dt.datetime(2019, 10, 25, 15, 16),
        event_time_kst=dt.datetime(2019, 10, 26, 0, 16),
        event_type="cart", product_id=4, category_id=1, category_code=None, brand=None,
        price=2.5, user_id=7, source_user_session="src", session_id="7_1572016560",
        session_start_utc=dt.datetime(2019, 10, 25, 15, 16),
        event_date_kst=dt.date(2019, 10, 26),
    )
