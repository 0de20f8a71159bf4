"""Each source file's rows stand in Bronze once, whatever the order of builds and loads."""

import os
import random
import tempfile
import uuid
from collections import Counter
from pathlib import Path

import pytest

from tideline import schemas
from tideline.plans import bronze, ledger, silver
from tideline.plans.lake import Lake
from tideline.sources import read_bronze


@pytest.fixture()
def lake(spark):
    made = Lake.under(tempfile.mkdtemp(prefix="run-", dir="/tmp"), f"t_{uuid.uuid4().hex}")
    yield made
    spark.sql(f"DROP DATABASE IF EXISTS `{made.silver.database}` CASCADE")


@pytest.fixture()
def source():
    return Path(tempfile.mkdtemp(prefix="run-", dir="/tmp"))


def write(folder: Path, name: str, *times: str) -> str:
    """A file with an event of a user of its own at each time; a later one has another time of change."""
    folder.mkdir(parents=True, exist_ok=True)
    file = folder / f"{name}.csv"
    lines = [",".join(schemas.RAW.names)]
    lines += [f"{t} UTC,view,1,2,c,b,9.5,{1 + n},{name}" for n, t in enumerate(times)]
    before = file.stat().st_mtime if file.exists() else 0
    file.write_text("\n".join(lines) + "\n")
    if before:
        os.utime(file, (before + 5, before + 5))
    return str(folder)


def rows(spark, lake):
    found = read_bronze(spark, lake.bronze.name, lake.bronze_loads.name).collect()
    return Counter((r.user_session, r.event_time.removesuffix(" UTC")) for r in found)


D1, D2, D3 = ("2019-10-25 10:00:00", "2019-10-26 10:00:00", "2019-10-27 10:00:00")


def test_a_build_after_a_load_leaves_its_files(spark, lake, source):
    a, b = write(source / "a", "a", D1, "bad"), write(source / "b", "b", D1, D2)
    assert bronze.add_csv_load(spark, lake, a, "a") == 2
    assert bronze.build_bronze(spark, lake, [a, b]) == 2
    assert rows(spark, lake) == {("a", D1): 1, ("a", "bad"): 1, ("b", D1): 1, ("b", D2): 1}
    silver.ingest(spark, lake, "2019-10-25", "2019-10-26")
    assert spark.table(lake.silver.name).count() == 3
    assert bronze.build_bronze(spark, lake, [a, b]) == 2
    assert sum(rows(spark, lake).values()) == 4


def test_a_load_after_a_build_takes_new_files_only(spark, lake, source):
    a, b = write(source / "a", "a", D1), write(source / "b", "b", D1)
    bronze.build_bronze(spark, lake, a)
    assert bronze.add_csv_load(spark, lake, [a, b], "k") == 1
    assert bronze.add_csv_load(spark, lake, [a, b], "k") == 1
    assert bronze.add_csv_load(spark, lake, [a, b], "other") == 0
    assert rows(spark, lake) == {("a", D1): 1, ("b", D1): 1}
    held = {r.file_path.rpartition("/")[2]: (r.holder, r.rows, r.day_folders, r.whole)
            for r in ledger.open_ledger(spark, lake).collect()}
    assert held == {"a.csv": (ledger.BUILD, 1, ["2019-10-25"], True), "b.csv": ("k", 1, ["2019-10-25"], True)}


def test_a_changed_file_replaces_its_earlier_version(spark, lake, source):
    a = write(source / "a", "a", D1, D2, "bad")
    write(source / "a", "a2", D1)
    bronze.add_csv_load(spark, lake, a, "a")
    write(source / "a", "a", D2, D3)
    assert bronze.add_csv_load(spark, lake, a, "later") == 2
    want = {("a", D2): 1, ("a", D3): 1, ("a2", D1): 1}
    assert rows(spark, lake) == want
    write(source / "a", "a", D3)
    assert bronze.build_bronze(spark, lake, a) == 1
    assert rows(spark, lake) == {("a", D3): 1, ("a2", D1): 1}
    write(source / "a", "a", D1)  # a build brings the new version, and drops its own earlier one
    assert bronze.build_bronze(spark, lake, a) == 1
    assert rows(spark, lake) == {("a", D1): 1, ("a2", D1): 1}
    write(source / "a", "a", D2, D2)
    assert bronze.add_csv_load(spark, lake, a, "a") == 3  # its own a2, and a from the build
    assert rows(spark, lake) == {("a", D2): 2, ("a2", D1): 1}


def test_a_partial_build_replaces_days_or_keeps_other_files(spark, lake, source):
    a, b = write(source / "a", "a", D1, D2), write(source / "b", "b", D2, D3)
    bronze.build_bronze(spark, lake, a)
    bronze.build_bronze(spark, lake, b)
    assert rows(spark, lake) == {("a", D1): 1, ("b", D2): 1, ("b", D3): 1}
    assert bronze.add_csv_load(spark, lake, a, "a") == 2  # not whole in the build: read again
    assert rows(spark, lake) == {("a", D1): 1, ("a", D2): 1, ("b", D2): 1, ("b", D3): 1}

    c = write(source / "c", "c", D2, "bad")
    bronze.build_bronze(spark, lake, c, keep_other_files=True)
    whole = rows(spark, lake)
    assert whole == {("a", D1): 1, ("a", D2): 1, ("b", D2): 1, ("b", D3): 1, ("c", D2): 1, ("c", "bad"): 1}
    assert bronze.add_csv_load(spark, lake, [a, b, c], "all") == 0
    assert rows(spark, lake) == whole


def test_a_failed_run_is_put_right_by_the_next(spark, lake, source, monkeypatch):
    a, b = write(source / "a", "a", D1, D2), write(source / "b", "b", D1)

    def broken(*args, **more):
        raise RuntimeError("lost")

    for store in (lambda: bronze.build_bronze(spark, lake, [a, b]), lambda: bronze.add_csv_load(spark, lake, a, "x")):
        with monkeypatch.context() as patch:
            patch.setattr(ledger, "complete", broken)  # rows are there, entries are not whole
            with pytest.raises(RuntimeError):
                store()
        assert bronze.add_csv_load(spark, lake, [a, b], "k") == 3
        assert rows(spark, lake) == {("a", D1): 1, ("a", D2): 1, ("b", D1): 1}


def test_rows_without_files_and_lakes_without_a_ledger(spark, lake, source):
    a = write(source / "a", "a", D1)
    bronze.add_csv_load(spark, lake, a, "k")
    raw = spark.createDataFrame([(f"{D2} UTC", *["1"] * 8)], schemas.RAW)
    bronze.add_load(spark, lake, raw, "k")
    assert bronze.add_csv_load(spark, lake, a, "x") == 1
    bronze.build_bronze(spark, lake, a)
    assert rows(spark, lake) == {("a", D1): 1, ("1", D2): 1}
    plain = Lake(lake.bronze, lake.bronze_loads, lake.silver, lake.gold)
    assert bronze.build_bronze(spark, plain, a) == 1
    with pytest.raises(ValueError):
        bronze.build_bronze(spark, plain, a, keep_other_files=True)


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_whole_builds_and_loads(spark, lake, source, seed):
    draw, now = random.Random(seed), {}
    stamps = [D1, D2, D3, "bad"]
    for step in range(6):
        for name in draw.sample("abcd", 2):
            if name not in now or draw.random() < 0.4:
                now[name] = draw.choices(stamps, k=draw.randint(0, 4))
                write(source / name, name, *now[name])
        sent = [str(source / n) for n in sorted(now)]
        if draw.random() < 0.4:
            bronze.build_bronze(spark, lake, sent, keep_other_files=True)
        else:
            bronze.add_csv_load(spark, lake, sent, draw.choice("xyz"))
        if spark.catalog.tableExists(lake.bronze.name) or spark.catalog.tableExists(lake.bronze_loads.name):
            assert rows(spark, lake) == Counter((n, t) for n, times in now.items() for t in times)
