"""CSV -> Bronze: raw text rows, stored by UTC day.

A full build replaces the days it holds. Increments go to a table of their own, by the
caller's load key and then by day: a load replaces what was stored under its key and
nothing else, so rows without a readable time and days that two loads share are kept.
Silver reads both tables. The ledger (``plans.ledger``) sees to it that each source file's rows
stand in one of them, once.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tideline import schemas
from tideline.functions.clock import require_utc_session
from tideline.operators.cleaning import lost_values, with_utc_day
from tideline.plans import ledger
from tideline.plans.audit import RunRecord, recorded_run
from tideline.plans.lake import Lake
from tideline.sinks import (
    create_layer_table,
    forget_partitions,
    register_days,
    register_partitions,
    replace_days,
    replace_load,
)
from tideline.sources import read_raw_csv


def store_bronze(
    spark: SparkSession,
    lake: Lake,
    raw: DataFrame,
    source: str = "",
    run_id: str | None = None,
    time_format: str | None = None,
) -> int:
    """Stores raw rows and returns their number.

    UTC days present in ``raw`` are replaced as a whole, so it must hold all rows of
    the days it touches. Rows without a readable time are kept, under a null day.
    """
    require_utc_session(spark)
    with recorded_run(spark, lake.audit_path, run_id, source, lake.bronze.path) as run:
        run.row_count = _replace_bronze(spark, lake, raw, time_format, None, run)
    return run.row_count


def build_bronze(
    spark: SparkSession,
    lake: Lake,
    csv_paths: str | Sequence[str],
    header: bool = True,
    run_id: str | None = None,
    time_format: str | None = None,
    keep_other_files: bool = False,
) -> int:
    """Stores the whole of a CSV directory; ``add_load`` is for parts that come one by one.

    Files that a load holds unchanged stay with it and are not read again; of changed ones
    the load's rows are replaced. UTC days that the files have rows on are replaced as a
    whole, so a part of a day's files would replace all of them; ``keep_other_files``
    writes what other files have on these days again. Returns the number of rows written.
    """
    require_utc_session(spark)
    paths = [csv_paths] if isinstance(csv_paths, str) else list(csv_paths)
    with recorded_run(
        spark, lake.audit_path, run_id, ",".join(paths), lake.bronze.path
    ) as run:
        raw, batch = _sorted_out(spark, lake, paths, ledger.BUILD, header)
        if keep_other_files and batch is None:
            raise ValueError("a lake without a ledger of files cannot tell them apart")
        run.row_count = _replace_bronze(
            spark, lake, raw, time_format, batch, run, keep_other_files
        )
    return run.row_count


def _sorted_out(
    spark: SparkSession, lake: Lake, paths: list[str], holder: str, header: bool
) -> tuple[DataFrame, ledger.Batch | None]:
    if lake.bronze_files is None:
        return read_raw_csv(spark, paths, header), None
    batch = ledger.sorted_out(spark, lake, paths, holder)
    return batch.rows(spark, header), batch


def _replace_bronze(
    spark: SparkSession,
    lake: Lake,
    raw: DataFrame,
    time_format: str | None,
    batch: ledger.Batch | None,
    run: RunRecord,
    keep_other_files: bool = False,
) -> int:
    create_layer_table(spark, lake.bronze, schemas.BRONZE, schemas.BRONZE_DAY)
    before = ledger.announce(spark, lake, ledger.BUILD, batch) if lake.bronze_files else []
    rows = with_utc_day(raw, time_format)
    if keep_other_files:
        days = [r[0] for r in rows.select(schemas.BRONZE_DAY).distinct().collect()]  # a row a day
        others = ledger.rows_of_others(spark, lake, batch, days)
        rows = rows.select(*others.columns).unionByName(others)
    seen = Observation("bronze")
    replace_days(
        rows,
        lake.bronze.path,
        schemas.BRONZE_DAY,
        observation=seen,
        metrics=_metrics(),
    )
    register_days(spark, lake.bronze, schemas.BRONZE_DAY, _days(seen))
    if lake.bronze_files:
        ledger.complete(spark, lake, ledger.BUILD, batch, before, _days(seen), keep_other_files)
    _note(run, seen)
    return seen.get.get("rows", 0)


def _metrics() -> tuple:
    """Rows, days (one entry each, however many rows they have), rows without a day."""
    day = F.col(schemas.BRONZE_DAY)
    return (
        F.count(F.lit(1)).alias("rows"),
        F.sort_array(F.collect_set(day)).alias("days"),
        F.count_if(day.isNull()).alias("without_day"),
        *[F.count_if(lost).alias(name) for name, lost in lost_values().items()],
    )


def _note(run: RunRecord, seen: Observation) -> None:
    """Days and lost values of the rows just written, counted in the writing stage."""
    run.wrote(_days(seen))
    run.lost_values = {name: seen.get.get(name, 0) for name in lost_values()}


def _days(seen: Observation) -> list:
    found = list(seen.get.get("days") or [])
    return found + [None] * bool(seen.get.get("without_day"))


def add_load(
    spark: SparkSession,
    lake: Lake,
    raw: DataFrame,
    load_key: str,
    source: str = "",
    run_id: str | None = None,
    time_format: str | None = None,
) -> int:
    """Stores raw rows under a load key, replacing what the key held, and returns their
    number. Letters, digits and ``_ . -`` make a key, such as the name of a file's day."""
    _check_key(load_key)
    require_utc_session(spark)
    with recorded_run(
        spark, lake.audit_path, run_id, source, ledger.place_of(lake, load_key)
    ) as run:
        run.row_count = _replace_load(spark, lake, raw, load_key, time_format, None, run)
    return run.row_count


def _check_key(load_key: str) -> None:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", load_key):
        raise ValueError(f"not a load key: {load_key!r}")


def _replace_load(
    spark: SparkSession,
    lake: Lake,
    raw: DataFrame,
    load_key: str,
    time_format: str | None,
    batch: ledger.Batch | None,
    run: RunRecord,
) -> int:
    table, place = lake.bronze_loads, ledger.place_of(lake, load_key)
    create_layer_table(spark, table, schemas.BRONZE_LOADS, (schemas.LOAD_KEY, schemas.BRONZE_DAY))
    before = ledger.announce(spark, lake, load_key, batch) if lake.bronze_files else []
    seen = Observation("load")
    replace_load(
        with_utc_day(raw, time_format), place, schemas.BRONZE_DAY, observation=seen, metrics=_metrics()
    )
    old = spark.sql(f"SHOW PARTITIONS {table.name} PARTITION ({schemas.LOAD_KEY} = '{load_key}')")
    texts = {r[0].rpartition("=")[2] for r in old.collect()}
    stale = texts - {str(d) for d in _days(seen)}
    forget_partitions(
        spark,
        table,
        [
            {schemas.LOAD_KEY: load_key, schemas.BRONZE_DAY: t if t[:1].isdigit() else None}
            for t in stale
            if t[:1].isdigit() or None not in _days(seen)
        ],
    )
    register_partitions(
        spark, table, [{schemas.LOAD_KEY: load_key, schemas.BRONZE_DAY: d} for d in _days(seen)]
    )
    if lake.bronze_files:
        ledger.complete(spark, lake, load_key, batch, before, _days(seen))
    _note(run, seen)
    return seen.get.get("rows", 0)


def add_csv_load(
    spark: SparkSession,
    lake: Lake,
    csv_paths: str | Sequence[str],
    load_key: str,
    header: bool = True,
    run_id: str | None = None,
    time_format: str | None = None,
) -> int:
    """``add_load`` of CSV files, but for those that the full build or another load holds
    unchanged. Earlier versions of changed ones are taken out of their holder."""
    _check_key(load_key)
    require_utc_session(spark)
    paths = [csv_paths] if isinstance(csv_paths, str) else list(csv_paths)
    with recorded_run(
        spark, lake.audit_path, run_id, ",".join(paths), ledger.place_of(lake, load_key)
    ) as run:
        raw, batch = _sorted_out(spark, lake, paths, load_key, header)
        run.row_count = _replace_load(spark, lake, raw, load_key, time_format, batch, run)
    return run.row_count
