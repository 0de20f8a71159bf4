import datetime as dt
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from test_tables import events, per_day
from tideline import schemas
from tideline.plans import bronze, silver
from tideline.plans.lake import Lake
from tideline.sinks import LayerTable, clear_replaced, settle, versions

DAYS = ("2019-10-25", "2019-10-26", "2019-10-27")
OLD = dict.fromkeys(DAYS, 1)
NEW = dict.fromkeys(DAYS, 2)


@pytest.fixture()
def lake(spark):
    """Three days with one row each in Silver, and with two in Bronze."""
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    made = Lake.under(f"{root}/it's", f"t_{uuid.uuid4().hex}", versioned_silver=True)
    bronze.store_bronze(spark, made, events(spark, *[f"{d} 01:00:00" for d in DAYS]))
    silver.ingest(spark, made, DAYS[0], DAYS[-1])
    more = [f"{d} 0{hour}:00:00" for d in DAYS for hour in (1, 3)]
    bronze.store_bronze(spark, made, events(spark, *more))
    assert per_day(spark, made.silver.name) == OLD
    yield made
    spark.sql(f"DROP DATABASE IF EXISTS `{made.silver.database}` CASCADE")


def ingest(spark, lake):
    return silver.ingest(spark, lake, DAYS[0], DAYS[-1])


def fails_at(monkeypatch, day):
    """Moving this day fails once, and only it."""
    real, failed = versions.point_day, []

    def point_day(spark, table, column, moved, folder):
        if str(moved) == day and not failed:
            failed.append(moved)
            raise RuntimeError("lost the catalog")
        real(spark, table, column, moved, folder)

    monkeypatch.setattr(versions, "point_day", point_day)


def test_all_days_change(spark, lake):
    assert ingest(spark, lake).rows == 6
    assert per_day(spark, lake.silver.name) == NEW


@pytest.mark.parametrize("day", DAYS)
def test_a_run_that_fails_between_days_leaves_the_old_rows(spark, lake, monkeypatch, day):
    fails_at(monkeypatch, day)
    with pytest.raises(RuntimeError, match="lost the catalog"):
        ingest(spark, lake)
    assert per_day(spark, lake.silver.name) == OLD
    ingest(spark, lake)
    assert per_day(spark, lake.silver.name) == NEW


def test_new_days_go_again_when_their_run_fails(spark, lake, monkeypatch):
    late = [f"{d} 01:00:00" for d in ("2019-10-28", "2019-10-29")]
    bronze.store_bronze(spark, lake, events(spark, *late))
    fails_at(monkeypatch, "2019-10-29")
    with pytest.raises(RuntimeError):
        silver.ingest(spark, lake, "2019-10-28", "2019-10-29")
    assert per_day(spark, lake.silver.name) == OLD


def test_a_failed_write_leaves_the_old_rows(spark, lake):
    rows = spark.table(lake.silver.name)
    broken = rows.withColumn(
        "price", F.when(F.col(schemas.SILVER_DAY) == DAYS[1], F.raise_error(F.lit("bad row")).cast("double"))
    )
    with pytest.raises(Exception, match="bad row"):
        silver.write_silver(spark, lake, broken)
    assert per_day(spark, lake.silver.name) == OLD


def test_a_driver_that_died_is_settled(spark, lake, monkeypatch):
    with monkeypatch.context() as dies:
        fails_at(dies, DAYS[2])
        dies.setattr(versions, "_move_back", lambda *_: [])
        real = versions._record
        dies.setattr(versions, "_record", lambda *a: real(*a) if a[3] == versions.BEGUN else None)
        with pytest.raises(RuntimeError):
            ingest(spark, lake)
    assert per_day(spark, lake.silver.name) == {**OLD, DAYS[0]: 2, DAYS[1]: 2}
    assert settle(spark, lake.silver, schemas.SILVER_DAY) == [dt.date.fromisoformat(d) for d in DAYS[:2]]
    assert per_day(spark, lake.silver.name) == OLD
    assert settle(spark, lake.silver, schemas.SILVER_DAY) == []


def test_a_new_catalog_finds_the_days(spark, lake):
    ingest(spark, lake)
    bronze.store_bronze(spark, lake, events(spark, f"{DAYS[0]} 01:00:00", user="x"))
    gone = silver.ingest(spark, lake, DAYS[0], DAYS[0], drop_empty_days=True)
    assert gone.empty_days == [dt.date.fromisoformat(DAYS[0])]
    left = {d: 2 for d in DAYS[1:]}
    assert per_day(spark, lake.silver.name) == left
    spark.sql(f"DROP TABLE {lake.silver.name}")
    silver.create_silver(spark, lake)
    assert per_day(spark, lake.silver.name) == left


def test_replaced_folders_are_emptied(spark, lake):
    ingest(spark, lake)
    cleared = clear_replaced(spark, lake.silver, schemas.SILVER_DAY, schemas.SILVER)
    assert len(cleared) == 3 and len({c.split("/")[-2] for c in cleared}) == 1
    assert per_day(spark, lake.silver.name) == NEW
    assert spark.read.parquet(cleared[0]).isEmpty()
    assert clear_replaced(spark, lake.silver, schemas.SILVER_DAY, schemas.SILVER) == []


def test_days_are_pruned_by_the_catalog(spark, lake):
    ingest(spark, lake)
    day = spark.table(lake.silver.name).where(F.col(schemas.SILVER_DAY) == F.lit(DAYS[1]).cast("date"))
    assert day.count() == 2 and len(day.inputFiles()) >= 1
    assert all(DAYS[1] in f for f in day.inputFiles())


def test_clustered_and_versioned_is_refused():
    with pytest.raises(ValueError, match="not both"):
        LayerTable("d", "t", "/tmp/x", buckets=4, versioned=True)
