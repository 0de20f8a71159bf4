import datetime as dt
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from test_sessions import raw_rows
from tideline import schemas
from tideline.operators.cleaning import with_utc_day
from tideline.operators.ranges import days_between
from tideline.plans import audit, bronze, gold, silver
from tideline.plans.lake import Lake
from tideline.sinks import LayerTable, create_layer_table, register_days, repair_partitions, replace_days
from tideline.sources import read_raw_csv


@pytest.fixture()
def lake(spark):
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").upper() == "STATIC"
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    made = Lake.under(root, f"t_{uuid.uuid4().hex}")
    yield made
    spark.sql(f"DROP DATABASE IF EXISTS `{made.silver.database}` CASCADE")


def events(spark, *texts, user="1", kind="view"):
    return raw_rows(spark, [(f"{t} UTC", kind, "1", "1", user, None) for t in texts])


def per_day(spark, table, day=schemas.SILVER_DAY):
    return {r[0] and r[0].isoformat(): r["count"]
            for r in spark.table(table).groupBy(day).count().collect()}


def chain(spark):
    """User 7, every 240 s, from 2019-10-01 00:00 to 2019-10-04 00:00."""
    at = F.timestamp_seconds(F.lit(1569888000) + F.col("id") * 240)
    return spark.range(1081).select(
        F.concat(F.date_format(at, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")).alias("event_time"),
        *[F.lit(v).cast("string").alias(c) for c, v in zip(
            schemas.RAW.names[1:], ("view", "1", "1", None, None, "1", "7", None))],
    )


def starts(spark, lake, day):
    rows = spark.table(lake.silver.name).filter(F.col(schemas.SILVER_DAY) == F.lit(day))
    return {r[0]: r[1] for r in rows.groupBy("session_id").count().collect()}


LAST = dt.date(2019, 10, 4)


def test_csv_goes_by_position(spark):
    folder = Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))
    (folder / "a.csv").write_text(
        "x,event_time,product_id,d,e,f,g,h,i\n"
        "t1,view,1,2,c,b,9.5,7,s\n"
        "t2,view\n"
        't3,view,1,2,"",,9.5,7,s,extra,more\n'
    )
    (folder / "b.csv").write_text("skipped\nt4,\"a,b\",1,2,c,b,1,7,s\n")
    rows = {r[0]: tuple(r)[1:] for r in read_raw_csv(spark, str(folder)).collect()}
    assert rows == {
        "t1": ("view", "1", "2", "c", "b", "9.5", "7", "s"),
        "t2": ("view",) + (None,) * 7,
        "t3": ("view", "1", "2", None, None, "9.5", "7", "s"),
        "t4": ("a,b", "1", "2", "c", "b", "1", "7", "s"),
    }
    assert read_raw_csv(spark, str(folder), header=False).count() == 6
    assert read_raw_csv(spark, str(folder)).schema == schemas.RAW
    several = read_raw_csv(spark, [str(folder / "a.csv"), str(folder / "b.csv")])
    assert several.count() == 4


def test_bronze_keeps_bad_rows(spark, lake):
    raw = events(spark, "2019-10-25 10:00:00", "garbage").unionByName(
        events(spark, "2019-10-25 11:00:00", user="abc"))
    assert bronze.store_bronze(spark, lake, raw) == 3
    assert per_day(spark, lake.bronze.name, schemas.BRONZE_DAY) == {None: 1, "2019-10-25": 2}
    assert spark.table(lake.bronze.name).schema == schemas.BRONZE
    silver.ingest(spark, lake, "2019-10-25", "2019-10-25")
    assert per_day(spark, lake.silver.name) == {"2019-10-25": 1}
    assert spark.table(lake.silver.name).schema == schemas.SILVER


def test_partial_overwrite_and_empty_batch(spark, lake):
    days = ["2019-10-25 10:00:00", "2019-10-26 10:00:00", "2019-10-27 10:00:00"]
    bronze.store_bronze(spark, lake, events(spark, *days))
    bronze.store_bronze(spark, lake, events(spark, days[1], "2019-10-26 11:00:00"))
    want = {"2019-10-25": 1, "2019-10-26": 2, "2019-10-27": 1}
    assert per_day(spark, lake.bronze.name, schemas.BRONZE_DAY) == want
    assert bronze.store_bronze(spark, lake, events(spark, *days).limit(0)) == 0
    assert per_day(spark, lake.bronze.name, schemas.BRONZE_DAY) == want


def test_rerun_gives_the_same_tables(spark, lake):
    bronze.store_bronze(spark, lake, chain(spark))
    done = silver.ingest(spark, lake, "2019-10-01", LAST)
    once = spark.table(lake.silver.name).collect()
    assert done.rows == len(once) == 1081
    assert done.written_days == [dt.date(2019, 10, d) for d in (1, 2, 3, 4)]
    assert silver.ingest(spark, lake, "2019-10-01", LAST) == done
    assert sorted(spark.table(lake.silver.name).collect()) == sorted(once)


def test_look_back_limits_a_long_session(spark, lake):
    bronze.store_bronze(spark, lake, chain(spark))
    done = silver.ingest(spark, lake, LAST, LAST)
    assert done.rows == 136
    assert starts(spark, lake, LAST) == {"7_1569974400": 136}


def test_going_on_from_silver_has_no_such_limit(spark, lake):
    bronze.store_bronze(spark, lake, chain(spark))
    assert silver.ingest_onward(spark, lake, "2019-10-01", "2019-10-03").rows == 945
    assert silver.ingest_onward(spark, lake, LAST, LAST).rows == 136
    assert starts(spark, lake, LAST) == {"7_1569888000": 136}


def test_empty_range_is_reported(spark, lake):
    bronze.store_bronze(spark, lake, chain(spark))
    silver.ingest(spark, lake, "2019-10-01", LAST)
    before = per_day(spark, lake.silver.name)
    done = silver.ingest(spark, lake, "2020-01-01", "2020-01-02")
    assert (done.rows, done.written_days) == (0, [])
    assert done.empty_days == [dt.date(2020, 1, 1), dt.date(2020, 1, 2)]
    assert per_day(spark, lake.silver.name) == before


def test_big_day_is_cut_into_files(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/t"
    replace_days(with_utc_day(chain(spark)), path, schemas.BRONZE_DAY, max_rows_per_file=100)
    files = sorted(Path(path).glob("event_date_utc=2019-10-01/*.parquet"))
    assert len(files) >= 4 and all(".snappy." in f.name for f in files)
    assert spark.read.parquet(path).count() == 1081


def test_external_table_needs_registered_days_and_keeps_files(spark, lake):
    create_layer_table(spark, lake.bronze, schemas.BRONZE, schemas.BRONZE_DAY)
    day = with_utc_day(events(spark, "2019-10-25 10:00:00"))
    replace_days(day, lake.bronze.path, schemas.BRONZE_DAY)
    assert spark.table(lake.bronze.name).count() == 0
    register_days(spark, lake.bronze, schemas.BRONZE_DAY, [dt.date(2019, 10, 25)])
    assert spark.table(lake.bronze.name).count() == 1
    create_layer_table(spark, lake.bronze, schemas.BRONZE, schemas.BRONZE_DAY)
    assert spark.table(lake.bronze.name).count() == 1
    spark.sql(f"DROP TABLE {lake.bronze.name}")
    assert spark.read.parquet(lake.bronze.path).count() == 1
    create_layer_table(spark, lake.bronze, schemas.BRONZE, schemas.BRONZE_DAY)
    assert spark.table(lake.bronze.name).count() == 1
    replace_days(with_utc_day(events(spark, "2019-10-27 10:00:00")), lake.bronze.path, schemas.BRONZE_DAY)
    repair_partitions(spark, lake.bronze)
    assert spark.table(lake.bronze.name).count() == 2


def test_a_name_with_files_elsewhere_is_refused(spark, lake):
    create_layer_table(spark, lake.bronze, schemas.BRONZE, schemas.BRONZE_DAY)
    other = LayerTable(lake.bronze.database, lake.bronze.table, lake.bronze.path + "2")
    with pytest.raises(ValueError):
        create_layer_table(spark, other, schemas.BRONZE, schemas.BRONZE_DAY)


def test_loads_keep_each_others_rows(spark, lake):
    add = lambda key, *texts: bronze.add_load(spark, lake, events(spark, *texts), key)
    assert add("one", "2019-10-25 10:00:00", "2019-10-26 01:00:00", "garbage-1") == 3
    assert add("two", "2019-10-26 10:00:00", "garbage-2") == 2
    assert add("two", "2019-10-26 10:00:00", "garbage-2") == 2
    times = lambda: sorted(r.event_time for r in spark.table(lake.bronze_loads.name).collect())
    assert times() == ["2019-10-25 10:00:00 UTC", "2019-10-26 01:00:00 UTC", "2019-10-26 10:00:00 UTC",
                       "garbage-1 UTC", "garbage-2 UTC"]
    add("two", "2019-10-28 10:00:00")
    assert times() == ["2019-10-25 10:00:00 UTC", "2019-10-26 01:00:00 UTC", "2019-10-28 10:00:00 UTC",
                       "garbage-1 UTC"]
    bronze.store_bronze(spark, lake, events(spark, "2019-10-25 12:00:00"))
    silver.ingest(spark, lake, "2019-10-25", "2019-10-29")
    assert per_day(spark, lake.silver.name) == {"2019-10-25": 2, "2019-10-26": 1, "2019-10-28": 1}
    with pytest.raises(ValueError):
        add("a/b", "2019-10-25 10:00:00")


def test_no_buffer_keeps_all_rows_of_the_day(spark, lake):
    bronze.store_bronze(spark, lake, events(spark, "2019-10-24 16:00:00", "2019-10-25 10:00:00"))
    for buffer in (2, 0):
        silver.ingest(spark, lake, "2019-10-25", "2019-10-25", buffer_days=buffer)
        assert per_day(spark, lake.silver.name) == {"2019-10-25": 2}


def test_going_on_needs_the_days_before(spark, lake):
    bronze.store_bronze(spark, lake, chain(spark))
    with pytest.raises(ValueError, match="2019-10-03"):
        silver.ingest_onward(spark, lake, LAST, LAST)
    assert silver.ingest_onward(spark, lake, LAST, LAST, from_nothing=True).rows == 136


def test_days_without_rows_can_be_dropped(spark, lake):
    bronze.store_bronze(spark, lake, events(spark, "2019-10-25 01:00:00", "2019-10-26 01:00:00"))
    silver.ingest(spark, lake, "2019-10-25", "2019-10-26")
    bronze.store_bronze(spark, lake, events(spark, "2019-10-26 01:00:00", user="x"))
    kept = silver.ingest(spark, lake, "2019-10-26", "2019-10-26")
    assert per_day(spark, lake.silver.name) == {"2019-10-25": 1, "2019-10-26": 1}
    dropped = silver.ingest(spark, lake, "2019-10-26", "2019-10-26", drop_empty_days=True)
    assert kept.empty_days == dropped.empty_days == [dt.date(2019, 10, 26)]
    assert per_day(spark, lake.silver.name) == {"2019-10-25": 1}


def test_time_format_and_zone_reach_silver(spark, lake):
    raw = events(spark, "2019-10-25 23:30:00", "2019-10-25")
    strict = {"time_format": "yyyy-MM-dd HH:mm:ss", "zone": "Europe/Paris"}
    bronze.store_bronze(spark, lake, raw, time_format=strict["time_format"])
    silver.ingest(spark, lake, "2019-10-25", "2019-10-26", **strict)
    assert per_day(spark, lake.silver.name) == {"2019-10-26": 1}
    assert silver.ingest_onward(spark, lake, "2019-10-26", "2019-10-26", **strict).rows == 1


def test_all_weeks_are_reported(spark, lake):
    at = F.timestamp_seconds(F.lit(1420070400) + F.col("id") * 7 * 86_400)
    raw = spark.range(250).select(
        F.date_format(at, "yyyy-MM-dd HH:mm:ss").alias("event_time"),
        *[F.lit(v).cast("string").alias(c) for c, v in zip(
            schemas.RAW.names[1:], ("view", "1", "1", None, None, "1", "7", None))],
    )
    bronze.store_bronze(spark, lake, raw)
    silver.ingest(spark, lake, "2015-01-01", "2019-12-31")
    users, found = gold.activity_report(spark, lake)
    assert users.count() == found.count() == 250


def test_quoted_location(spark, lake):
    place = LayerTable(lake.bronze.database, "odd", f"{lake.bronze.path}'s \"x\"")
    create_layer_table(spark, place, schemas.GOLD)
    spark.sql(f"INSERT INTO {place.name} VALUES (DATE'2019-10-07', 1, 2)")
    assert spark.read.parquet(place.path).count() == 1


def test_gold_is_replaced_as_a_whole(spark, lake):
    bronze.store_bronze(spark, lake, events(spark, "2019-10-06 14:58:00", "2019-10-06 15:01:00"))
    silver.ingest(spark, lake, "2019-10-01", "2019-10-13")
    weeks = {(dt.date(2019, 9, 30), 1, 1), (dt.date(2019, 10, 7), 1, 1)}
    assert {tuple(r) for r in gold.build_gold(spark, lake).collect()} == weeks
    assert spark.table(lake.gold.name).schema == schemas.GOLD
    assert starts(spark, lake, dt.date(2019, 10, 7)) == {"1_1570373880": 1}

    bronze.store_bronze(spark, lake, events(spark, "2019-10-06 14:58:00", "2019-10-06 20:00:00",
                                            user="2"))
    silver.ingest(spark, lake, "2019-10-07", "2019-10-13")
    assert {tuple(r) for r in gold.build_gold(spark, lake).collect()} == weeks
    assert len(list(Path(lake.gold.path).glob("week=*/*.parquet"))) == 2  # a file a week
    users, found = gold.activity_report(spark, lake)
    assert [tuple(r) for r in users.collect()] == [
        (dt.datetime(2019, 9, 30), 1), (dt.datetime(2019, 10, 7), 1)]
    assert users.columns + found.columns == [
        "week_start_date", "wau_by_user", "week_start_date", "wau_by_session"]


def test_week_refresh_equals_full_refresh(spark, lake):
    raw = chain(spark).unionByName(events(spark, "2019-10-09 01:00:00", "2019-10-17 01:00:00"))
    bronze.store_bronze(spark, lake, raw)
    for start, end in (("2019-10-01", "2019-10-08"), ("2019-10-09", "2019-10-20")):
        done = silver.ingest(spark, lake, start, end)
        by_week = gold.refresh_gold_weeks(spark, lake, done.written_days).collect()
    assert by_week == gold.build_gold(spark, lake).collect()
    assert len(by_week) == 3
    assert gold.refresh_gold_weeks(spark, lake, []).collect() == by_week


def test_refreshes_of_different_weeks_at_once_both_stay(spark, lake):
    days = [dt.date(2019, 10, 1) + dt.timedelta(days=7 * n) for n in range(6)]
    bronze.store_bronze(spark, lake, events(spark, *(f"{d} 01:00:00" for d in days)))
    silver.ingest(spark, lake, days[0], days[-1])
    empty = gold.refresh_gold_weeks(spark, lake, [])
    assert empty.collect() == []
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda day: gold.refresh_gold_weeks(spark, lake, [day], run_id=str(day)), days))
    weeks = [gold.monday_of(d) for d in days]
    assert [tuple(r) for r in gold.read_gold(spark, lake.gold.name).collect()] == [(w, 1, 1) for w in weeks]
    assert {p.name for p in Path(lake.gold.path).glob("week=*")} == {f"week={w}" for w in weeks}


def test_a_refresh_writes_its_weeks_only_and_empties_lost_ones(spark, lake):
    bronze.store_bronze(spark, lake, events(spark, "2019-10-01 01:00:00", "2019-10-09 01:00:00"))
    silver.ingest(spark, lake, "2019-10-01", "2019-10-09")
    gold.build_gold(spark, lake)
    untouched = {p: p.stat().st_mtime_ns for p in Path(lake.gold.path).glob("week=2019-09-30/*.parquet")}
    bronze.store_bronze(spark, lake, events(spark, "2019-10-09 01:00:00", user="x"))
    silver.ingest(spark, lake, "2019-10-09", "2019-10-09", drop_empty_days=True)
    left = gold.refresh_gold_weeks(spark, lake, [dt.date(2019, 10, 9)]).collect()
    assert [tuple(r) for r in left] == [(dt.date(2019, 9, 30), 1, 1)]
    assert untouched == {p: p.stat().st_mtime_ns for p in Path(lake.gold.path).glob("week=2019-09-30/*.parquet")}
    assert gold.build_gold(spark, lake).collect() == left


def test_report_of_an_empty_lake(spark, lake):
    users, found = gold.activity_report(spark, lake)
    assert users.collect() == found.collect() == []
    assert gold.build_gold(spark, lake).collect() == []


def test_show_report(spark, lake, capfd):
    gold.show_report(spark.range(3), "Three")
    assert "Three\n" in capfd.readouterr().out


def test_run_records(spark, lake):
    bronze.store_bronze(spark, lake, chain(spark), source="here", run_id="b")
    silver.ingest(spark, lake, "2019-10-02", "2019-10-03", run_id="s")
    with pytest.raises(Exception):
        bronze.build_bronze(spark, lake, f"{lake.bronze.path}/missing", run_id="broken")
    with pytest.raises(RuntimeError):
        with audit.recorded_run(spark, lake.audit_path, "again", "i", "o"):
            raise RuntimeError("first try")
    with audit.recorded_run(spark, lake.audit_path, "again", "i", "o") as run:
        run.row_count = 5
    records = audit.read_audit(spark, lake.audit_path)
    assert records.schema == schemas.AUDIT
    last = {r.run_id: r for r in audit.latest_status(records).collect()}
    assert {k: (r.status, r.row_count) for k, r in last.items()} == {
        "b": ("SUCCESS", 1081), "s": ("SUCCESS", 720), "broken": ("FAILED", None),
        "again": ("SUCCESS", 5),
    }
    assert (last["s"].target_start_date, last["s"].target_end_date) == ("2019-10-02", "2019-10-03")
    assert last["b"].input_path == "here" and last["b"].output_path == lake.bronze.path
    assert "missing" in last["broken"].error_message and last["broken"].finished_at
    assert records.filter("run_id = 's'").count() == 2


def test_records_have_days_and_lost_values(spark, lake):
    raw = events(spark, "2019-10-02 10:00:00", "garbage").unionByName(
        events(spark, "2019-10-04 10:00:00", user="x")).unionByName(
        raw_rows(spark, [(None, "view", "1.5", "cheap", None, None)]))
    bronze.store_bronze(spark, lake, raw, run_id="b")
    bronze.add_load(spark, lake, raw.limit(0), "k", run_id="l")
    silver.ingest(spark, lake, "2019-10-02", "2019-10-04", run_id="s")
    with pytest.raises(Exception):
        bronze.build_bronze(spark, lake, f"{lake.bronze.path}/missing", run_id="broken")
    old = f"{lake.audit_path}/old"  # a record of before there were such fields
    spark.sql("SELECT 'o' run_id, 'SUCCESS' status, '1' started_at, '2' finished_at").write.json(old)
    latest = audit.latest_status(audit.read_audit(spark, lake.audit_path))
    last = {r.run_id: r for r in latest.collect()}
    assert last["b"].written_days == ["2019-10-02", "2019-10-04", "none"] and last["b"].expected_days is None
    lost = {k: n for k, n in last["b"].lost_values.items() if n}
    assert lost == {"event_time:missing": 1, "event_time:unreadable": 1, "user_id:missing": 1,
                    "user_id:unreadable": 1, "product_id:unreadable": 1, "price:unreadable": 1}
    assert set(last["l"].lost_values.values()) == {0} and last["l"].written_days == []
    assert last["s"].expected_days == ["2019-10-02", "2019-10-03", "2019-10-04"]
    assert last["s"].written_days == ["2019-10-02"]
    for run in ("broken", "o"):
        assert last[run].written_days is None and last[run].lost_values is None
    missed = {tuple(r) for r in audit.days_without_rows(latest).collect()}
    assert missed == {("s", "2019-10-03"), ("s", "2019-10-04")}


def test_two_runs_record_at_once(spark, lake):
    with audit.recorded_run(spark, lake.audit_path, "one", "i", "o") as one:
        with audit.recorded_run(spark, lake.audit_path, "two", "i", "o") as two:
            two.row_count = 2
        one.row_count = 1
    with ThreadPoolExecutor(4) as pool:
        record = lambda n: audit.append_record(
            spark, lake.audit_path, audit.RunRecord(f"r{n}", "SUCCESS", "i", "o", None, None, n, "s", "f"))
        list(pool.map(record, range(8)))
    last = {r.run_id: r.row_count for r in audit.latest_status(audit.read_audit(spark, lake.audit_path)).collect()}
    assert last == {"one": 1, "two": 2, **{f"r{n}": n for n in range(8)}}


def test_default_run_id_is_the_local_time():
    assert dt.datetime.strptime(audit.new_run_id(), "%Y%m%d_%H%M%S")


def test_refused_arguments(spark, lake):
    with pytest.raises(ValueError):
        silver.ingest(spark, lake, "2019-10-02", "2019-10-01")
    with pytest.raises(ValueError):
        days_between(chain(spark), "event_time", "2019-10-01", "2019-10-02", buffer_days=-1)


def test_other_session_zone_is_refused(spark, lake):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Seoul")
    try:
        with pytest.raises(ValueError):
            bronze.store_bronze(spark, lake, chain(spark))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
