"""Days of a table that are published together: each run writes into a folder of its own, and
the catalog's partitions point to it once everything is written.

A journal under the table's place keeps every move of a day from one folder to another. A
run that fails while it writes moves nothing; one that fails while it moves is moved back,
by itself or, if its driver died, by `settle`. The journal also tells a new catalog where
the days are. Replaced folders stay until `clear_replaced`, for queries still reading them.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from tideline.sinks.catalog import (
    LayerTable,
    forget_partitions,
    known_days,
    partition_spec,
    plain_place,
    quoted,
)
from tideline.sinks.parquet import empty_folder, replace_load

BEGUN, DONE, UNDONE = "BEGUN", "DONE", "UNDONE"
_JOURNAL = (
    "token string, state string, at timestamp, "
    "moves array<struct<day: date, folder: string, replaced: string>>"
)
Move = tuple[dt.date, str | None, str | None]  # day, its new folder, the folder before


def write_version(
    df: DataFrame,
    table: LayerTable,
    day_column: str,
    observation: Observation | None = None,
    metrics: tuple[Column, ...] = (),
) -> str:
    """Writes day partitions to a new folder, which no query reads yet."""
    folder = f"{table.path}/_versions/{uuid.uuid4().hex}"
    replace_load(df, folder, day_column, observation=observation, metrics=metrics)
    return folder


def publish_days(
    spark: SparkSession,
    table: LayerTable,
    day_column: str,
    version: str | None,
    days: Iterable[dt.date],
) -> None:
    """Points the days to their folders in a written version; without one, takes them out
    of the table. All of them change, or none."""
    moves = [
        (day, version and f"{version}/{day_column}={day}", _place(spark, table, day_column, day))
        for day in days
    ]
    if not moves:
        return
    token = uuid.uuid4().hex
    _record(spark, table, token, BEGUN, moves)
    try:
        for day, folder, _ in moves:
            point_day(spark, table, day_column, day, folder)
        _record(spark, table, token, DONE, moves)
    except BaseException:
        _move_back(spark, table, day_column, moves)
        _record(spark, table, token, UNDONE, moves)
        raise
    finally:
        spark.catalog.refreshTable(table.name)


def settle(spark: SparkSession, table: LayerTable, day_column: str) -> list[dt.date]:
    """Moves back what runs whose driver died had moved, and returns their days. Not to be
    called while another run publishes."""
    ended = F.max(F.col("state") != BEGUN).alias("ended")
    runs = _journal(spark, table).groupBy("token").agg(ended, F.first("moves").alias("moves"))
    days = []
    for run in runs.where("not ended").collect():  # runs that died since the last call
        moves = [tuple(m) for m in run["moves"]]
        days += _move_back(spark, table, day_column, moves)
        _record(spark, table, run["token"], UNDONE, moves)
    spark.catalog.refreshTable(table.name)
    return sorted(set(days))


def restore_published(spark: SparkSession, table: LayerTable, day_column: str) -> None:
    """Points every day to the folder that the journal has for it, and begins the journal of
    a new table: for a table that is new to the catalog."""
    _record(spark, table, uuid.uuid4().hex, DONE, [])
    for row in _current(spark, table).collect():  # one row a day
        point_day(spark, table, day_column, row["day"], row["folder"])
    spark.catalog.refreshTable(table.name)


def clear_replaced(
    spark: SparkSession, table: LayerTable, day_column: str, schema: StructType
) -> list[str]:
    """Empties the folders that no day points to any more, and returns them. Queries that
    began before must have ended. Each folder is emptied once."""
    moves = _journal(spark, table).select("state", F.explode("moves").alias("move"))
    done, undone = (moves.where(F.col("state") == state) for state in (DONE, UNDONE))
    known = known_days(spark, table, day_column)
    held = {_place(spark, table, day_column, day) for day in known}
    left = done.select("move.replaced").union(undone.select("move.folder")).where("replaced is not null")
    columns = StructType([f for f in schema if f.name != day_column])
    cleared = []
    for row in left.distinct().collect():  # one row a replaced folder
        folder = row["replaced"]
        if plain_place(folder) not in held and not spark.read.schema(columns).parquet(folder).isEmpty():
            empty_folder(spark, columns, folder)
            cleared.append(folder)
    return sorted(cleared)


def point_day(
    spark: SparkSession, table: LayerTable, day_column: str, day: dt.date, folder: str | None
) -> None:
    """Makes a folder the day's partition, or takes the day out of the table."""
    if folder is None:
        forget_partitions(spark, table, [{day_column: day}])
        return
    spec = partition_spec({day_column: day})
    spark.sql(f"ALTER TABLE {table.name} ADD IF NOT EXISTS {spec} LOCATION {quoted(folder)}")
    spark.sql(f"ALTER TABLE {table.name} {spec} SET LOCATION {quoted(folder)}")


def _place(spark: SparkSession, table: LayerTable, day_column: str, day: dt.date) -> str | None:
    """The folder of the day's partition, if it has one."""
    spec = partition_spec({day_column: day})
    if spark.sql(f"SHOW PARTITIONS {table.name} {spec}").isEmpty():
        return None
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table.name} {spec}")
    return plain_place(described.where("col_name = 'Location'").first()["data_type"])


def _move_back(spark: SparkSession, table: LayerTable, day_column: str, moves: list[Move]) -> list[dt.date]:
    """Undoes the moves that were made and have not been replaced since."""
    back = []
    for day, folder, replaced in moves:
        now = _place(spark, table, day_column, day)
        if now != replaced and now == (folder and plain_place(folder)):
            point_day(spark, table, day_column, day, replaced)
            back.append(day)
    return back


def _record(spark: SparkSession, table: LayerTable, token: str, state: str, moves: list[Move]) -> None:
    text = json.dumps([{"day": str(d), "folder": f, "replaced": r} for d, f, r in moves])
    shape = "array<struct<day: date, folder: string, replaced: string>>"
    row = spark.range(1).coalesce(1).select(
        F.lit(token).alias("token"),
        F.lit(state).alias("state"),
        F.lit(dt.datetime.now(dt.UTC)).alias("at"),
        F.from_json(F.lit(text), shape).alias("moves"),
    )
    # A folder for each record: runs at the same time never share a commit.
    row.write.json(f"{table.path}/_journal/{uuid.uuid4().hex}")


def _journal(spark: SparkSession, table: LayerTable) -> DataFrame:
    return spark.read.schema(_JOURNAL).json(f"{table.path}/_journal/*")


def _current(spark: SparkSession, table: LayerTable) -> DataFrame:
    """(day, folder) after all moves that were done; folder is null where the day went."""
    done = _journal(spark, table).where(F.col("state") == DONE)
    moves = done.select("at", F.explode("moves").alias("move")).select("at", "move.*")
    return moves.groupBy("day").agg(F.max_by("folder", "at").alias("folder"))
