"""What the physical plans must look like for large, skewed data."""

import re
import tempfile
from contextlib import contextmanager
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks import queries, raw_events as given
from tideline import schemas
from tideline.operators import activity, sessions
from tideline.operators.cleaning import clean_events, typed_events, with_utc_day
from tideline.operators.ranges import days_between
from tideline.plans import bronze as bronze_plans, repair, silver as silver_plans
from tideline.plans.silver import onward_range, silver_range
from tideline.sinks import replace_days

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture()
def large_scale(spark):
    """Planner settings under which nothing is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def bronze(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/bronze"
    raw = given.raw_events(spark, SF_DIR).select(*schemas.RAW.names)
    replace_days(with_utc_day(raw), path, schemas.BRONZE_DAY)
    return spark.read.parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    """The adaptive plan after a run of it."""
    executed = df._jdf.queryExecution().executedPlan()
    executed.executeCollect()
    return executed.toString()


def clean_of(bronze):
    return clean_events(typed_events(bronze.drop(schemas.BRONZE_DAY)))


def test_range_read_prunes_days(bronze):
    text = plan(days_between(bronze, schemas.BRONZE_DAY, "2024-01-10", "2024-01-11", 2))
    filters = re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", text).group(1)
    assert "2024-01-08" in filters and "2024-01-11" in filters
    assert "cast" not in filters


def test_full_rows_are_shuffled_once_and_never_windowed(large_scale, bronze):
    text = plan(sessions.sessionize(clean_of(bronze), 1800))
    lines = text.splitlines()
    window_inputs = [line for line in lines if " Window " in line]
    assert window_inputs and not any("category_code" in line for line in window_inputs)
    assert text.count("Exchange hashpartitioning") == 4
    assert "partial_min(event_time_utc" in text
    assert len(re.findall(r"hashpartitioning\(user_id#\d+L, \d+\)", text)) == 1
    for line in lines:
        if "hashpartitioning" in line and "bucket" not in line and "_grouping" not in line:
            assert re.search(r"hashpartitioning\(user_id#\d+L, \d+\)", line)


def test_windows_of_small_gaps_hold_a_span_of_a_user(large_scale, spark):
    """86,400 buckets are a day at a gap of one second; windows by user are over such spans."""
    text = plan(sessions.with_sessions(hot_events(spark, 1000), 1))
    specs = re.findall(r" Window \[.*?\], \[(.*?)\], \[(.*?)\]", text)
    assert len(specs) >= 4
    for keys, order in specs:
        keys, order = re.sub(r"#\d+L?", "", keys), re.sub(r"#\d+L?", "", order)
        assert keys == "user_id, span" or (keys == "user_id" and order.startswith("span "))


def test_full_rows_are_filtered_by_parsing_the_time_once(large_scale, bronze):
    text = plan(sessions.sessionize(clean_of(bronze)))
    filters = [line for line in text.splitlines() if "- Filter " in line and "EndsWith" in line]
    assert len(filters) == 2
    assert all(line.count("EndsWith") == 1 for line in filters)


def test_previous_event_shuffles_full_rows_once(large_scale, spark):
    text = plan(queries.previous_event(spark, SF_DIR))
    assert text.count("Exchange hashpartitioning") <= 7
    assert text.count("FileScan parquet") <= 3
    assert not re.search(r"Window .*first_row.*props", text)


def test_look_back_days_are_not_joined(large_scale, bronze):
    text = plan(silver_range(bronze.drop(schemas.BRONZE_DAY), "2024-01-10", "2024-01-20"))
    left, right = text.split("Window", 1)[0], text.split("Window", 1)[1]
    assert "2024-01-10" in left
    assert "2024-01-10" not in right


def test_narrow_side_reads_two_columns(large_scale, bronze):
    read = re.findall(r"ReadSchema: struct<(.*?)>", plan(sessions.sessionize(clean_of(bronze))))
    assert "event_time:string,user_id:string" in read


def test_weekly_activity_reads_three_columns_and_combines_before_the_shuffle(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/silver"
    replace_days(
        sessions.sessionize(given.clean(spark, SF_DIR)).select(*schemas.SILVER.names),
        path, schemas.SILVER_DAY,
    )
    text = plan(activity.weekly_activity(spark.read.parquet(path)))
    assert "ReadSchema: struct<user_id:bigint,session_id:string>" in text
    # The day comes from the directory names.
    both = [line for line in text.splitlines() if "user_id" in line and "session_id" in line]
    assert any("Exchange hashpartitioning" in line for line in both)
    # Spark names the two columns in either order.
    assert sum("HashAggregate(keys=" in line and "gid" in line for line in both) >= 2


@pytest.fixture(scope="module")
def clustered(spark):
    lake = queries.scratch_lake(spark, user_buckets=4)
    raw = given.raw_events(spark, SF_DIR).select(*schemas.RAW.names)
    bronze_plans.store_bronze(spark, lake, raw)
    silver_plans.ingest_onward(spark, lake, "2024-01-01", "2024-01-31", from_nothing=True)
    yield lake
    queries.drop_lake(spark, lake)


def test_looking_back_does_not_shuffle_clustered_silver(large_scale, spark, clustered):
    silver = spark.table(clustered.silver.name)
    midnight = F.lit("2024-01-15 15:00:00").cast("timestamp")
    back = days_between(silver, schemas.SILVER_DAY, "2024-01-14", "2024-01-15")
    for df in (sessions.open_sessions(back, midnight, 1800), repair.moved_starts(silver, "2024-01-15", 1800)):
        text = final_plan(df)
        assert "Bucketed: true" in text and "Exchange" not in text
        assert "category" not in text
    onward = onward_range(
        spark.table(clustered.bronze.name), silver, "2024-01-16", "2024-01-20", 1800
    )
    scans = plan(onward).split("FileScan parquet")
    under = [s for s in scans if "silver_events" in s]
    assert len(under) == 1 and "Bucketed: true" in under[0]
    assert "category" not in under[0].split("ReadSchema")[1]


def test_clustered_days_are_files_by_user(spark, clustered):
    day = Path(clustered.silver.path.removeprefix("file:")) / "event_date_kst=2024-01-15"
    buckets = {re.search(r"_(\d{5})\.", f.name).group(1) for f in day.glob("*.parquet")}
    assert buckets <= {f"{n:05d}" for n in range(4)} and len(buckets) > 1


@contextmanager
def tiny_partitions(spark):
    """Adaptive execution as on large data: a few kilobytes count as a full partition."""
    small = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    old = {k: spark.conf.get(k, None) for k in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_events(spark, n):
    """A third of all rows in one (user, bucket)."""
    hot = F.col("id") % 3 == 0
    return clean_events(
        spark.range(0, n, 1, 8).select(
            F.col("id").alias("key"),
            F.when(hot, 0).otherwise(F.col("id") % 500).alias("user_id"),
            F.timestamp_seconds(
                F.lit(1_700_000_100) + F.when(hot, F.col("id") % 100).otherwise(F.col("id"))
            ).alias("event_time_utc"),
            F.sha2(F.col("id").cast("string"), 512).alias("payload"),
        )
    )


def test_hot_bucket_is_split_by_adaptive_execution(spark, large_scale):
    with tiny_partitions(spark):
        out = sessions.with_sessions(hot_events(spark, 60_000))
        assert "skew=true" in final_plan(out)
        assert out.count() == 60_000


def test_big_day_is_written_by_several_tasks(spark):
    path = tempfile.mkdtemp(prefix="run-", dir="/tmp") + "/t"
    with tiny_partitions(spark):
        replace_days(hot_events(spark, 60_000), path, schemas.SILVER_DAY)
    files = list(Path(path).glob("event_date_kst=2023-11-15/*.parquet"))
    assert len({re.match(r"part-(\d+)", f.name).group(1) for f in files}) > 3
    assert spark.read.parquet(path).count() == 60_000


@pytest.mark.parametrize("name", ["sessionize", "previous_event", "wau_top200"])
def test_no_python_and_no_cross_join(spark, name):
    text = plan(queries.QUERIES[name](spark, SF_DIR))
    for word in ("Python", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text
