"""The ledger of source files: each file's rows stand in Bronze once.

A file is known by its path, and is unchanged while its size and time of change are. It has one
holder: the full build, or the load under whose key it came. Files of a new batch are matched
with the ledger before any is read:

* unchanged files of another holder stay there and are not read;
* changed files are read, and the rows of their earlier version are taken out of the other
  holder, by rewriting the day folders that the ledger names;
* all others are read.

So a build after loads, loads after a build and files that are sent again leave every source
row in one place. A build also replaces whole days, by contract; asked to keep the rows of
other files, it writes theirs on its days again with its own. Entries are marked as not whole before rows are written and completed
after, and those of an earlier holder go last: a run that failed between is put right by
running it again. Batches with files in common must not be stored at the same time.

The ledger has a row a file. A batch's files, and their entries, go through the driver, as
the listing of every scan does.
"""

from __future__ import annotations

import datetime as dt
from collections import defaultdict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tideline import schemas
from tideline.plans.lake import Lake
from tideline.sinks import create_layer_table, empty_folder, register_partitions, replace_days
from tideline.sources import read_raw_csv

# The holder of full builds; no load key has this sign.
BUILD = "~build"
# Fixed value: the folder of rows whose day is null.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"

_STORED = T.StructType(
    schemas.RAW.fields
    + [
        T.StructField(schemas.SOURCE_FILE, T.StringType(), True),
        T.StructField(schemas.BRONZE_DAY, T.DateType(), True),
    ]
)
_KNOWN = [name for name in schemas.BRONZE_FILES.names if name != schemas.HOLDER]


@dataclass
class Batch:
    """Files to be read (all of a batch but those that others hold), those left to their
    holders, and entries of earlier versions with other holders."""

    taken: list[Row]
    left: list[str]
    outdated: list[Row]

    def rows(self, spark: SparkSession, header: bool) -> DataFrame:
        """Raw rows of the files to be read, with their file."""
        if not self.taken:
            named = T.StructType([*schemas.RAW.fields, _STORED[schemas.SOURCE_FILE]])
            return spark.createDataFrame([], named)
        raw = read_raw_csv(spark, [f.path for f in self.taken], header)
        return raw.select("*", F.col("_metadata.file_path").alias(schemas.SOURCE_FILE))


def place_of(lake: Lake, holder: str) -> str:
    if holder == BUILD:
        return lake.bronze.path
    return f"{lake.bronze_loads.path}/{schemas.LOAD_KEY}={holder}"


def open_ledger(spark: SparkSession, lake: Lake) -> DataFrame:
    create_layer_table(spark, lake.bronze_files, schemas.BRONZE_FILES, schemas.HOLDER)
    return spark.table(lake.bronze_files.name)


def listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The files under the paths, by the listing of a scan; none is opened."""
    return spark.read.format("binaryFile").load(list(paths)).select(
        "path",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_size").alias("file_size"),
        F.unix_millis("_metadata.file_modification_time").alias("file_time_ms"),
    )


def holders(spark: SparkSession, lake: Lake) -> set[str]:
    """Who has entries, from the catalog alone."""
    names = spark.sql(f"SHOW PARTITIONS {lake.bronze_files.name}").collect()
    return {r[0].partition("=")[2] for r in names}


def sorted_out(spark: SparkSession, lake: Lake, paths: Sequence[str], holder: str) -> Batch:
    files, known = listed(spark, paths), open_ledger(spark, lake)
    if not holders(spark, lake) - {holder}:
        return Batch(files.collect(), [], [])
    others = known.where(F.col(schemas.HOLDER) != holder)
    held = others.select("file_path", F.struct(*others.columns).alias("held"))
    by_file: dict[str, list[Row]] = defaultdict(list)
    for row in files.join(held, "file_path", "left").collect():
        by_file[row.file_path].append(row)  # one for each holder of a version of the file
    batch = Batch([], [], [])
    for path, rows in by_file.items():
        file, kept = rows[0], [r.held for r in rows if r.held and r.held.whole]
        if any((h.file_size, h.file_time_ms) == (file.file_size, file.file_time_ms) for h in kept):
            batch.left.append(path)
        else:
            batch.taken.append(file)
            batch.outdated += [r.held for r in rows if r.held]
    return batch


def entries_of(spark: SparkSession, lake: Lake, holder: str) -> list[Row]:
    ledger = open_ledger(spark, lake)
    if holder not in holders(spark, lake):
        return []
    return ledger.where(F.col(schemas.HOLDER) == holder).collect()


def write_entries(spark: SparkSession, lake: Lake, holder: str, entries: list[Row]) -> None:
    """Replaces all entries of the holder."""
    fields = T.StructType([schemas.BRONZE_FILES[name] for name in _KNOWN])
    columns = {name: [e[name] for e in entries] for name in _KNOWN}
    rows = pa.table(columns, schema=to_arrow_schema(fields))  # needs no Python worker
    table = lake.bronze_files
    folder = f"{table.path}/{schemas.HOLDER}={holder}"
    spark.createDataFrame(rows).coalesce(1).write.mode("overwrite").parquet(folder)
    register_partitions(spark, table, [{schemas.HOLDER: holder}])


def _entry(file: Row, rows: int | None, folders: list[str] | None, whole: bool) -> Row:
    values = (file.file_path, file.file_size, file.file_time_ms, rows, folders, whole)
    return Row(*_KNOWN)(*values)


def announce(spark: SparkSession, lake: Lake, holder: str, batch: Batch | None) -> list[Row]:
    """Marks the holder's entries, and those to come, as not whole; returns what they were."""
    before = entries_of(spark, lake, holder)
    taken = batch.taken if batch else []
    new = {f.file_path for f in taken}
    pending = [_entry(f, None, None, False) for f in taken]
    pending += [_entry(e, e.rows, e.day_folders, False) for e in before if e.file_path not in new]
    if pending:
        write_entries(spark, lake, holder, pending)
    return before


def complete(
    spark: SparkSession,
    lake: Lake,
    holder: str,
    batch: Batch | None,
    before: list[Row],
    written: Iterable[dt.date | None],
    kept_others: bool = False,
) -> None:
    """Records the files of the batch, whose rows have been written to these days, and takes
    out what is left of their earlier versions. `kept_others`: the days were written with the
    rows that other files have on them."""
    days, taken = list(written), batch.taken if batch else []
    found = _rows_by_file(spark, lake, holder, days) if taken else {}
    entries = [_entry(f, *found.get(f.file_path, (0, [])), True) for f in taken]
    if holder == BUILD:  # a build replaces the days it has rows on, and leaves the others
        new, replaced = {f.file_path for f in taken}, {_folder(day) for day in days}
        older = [e for e in before if e.file_path in new and _besides(e, replaced) != []]
        if older:
            on_days = _days_with(spark, lake, holder, older) - set(days)
            _rewrite_without(spark, lake, holder, older, on_days)
        for e in before:
            if e.file_path not in new:
                entries += [e] if kept_others else _shortened(e, replaced)
    if entries or before:
        write_entries(spark, lake, holder, entries)
    if batch:
        _evict(spark, lake, batch.outdated)


def _besides(entry: Row, replaced: set[str]) -> list[str] | None:
    """Day folders of a file besides those replaced; None is unknown ones."""
    return None if entry.day_folders is None else [f for f in entry.day_folders if f not in replaced]


def _shortened(entry: Row, replaced: set[str]) -> list[Row]:
    """What is left of an entry when these folders have been replaced."""
    rest = _besides(entry, replaced)
    if rest is not None and rest == entry.day_folders:
        return [entry]
    return [] if rest == [] else [_entry(entry, None, rest, False)]


def _folder(day: dt.date | None) -> str:
    return NO_DAY if day is None else day.isoformat()


def _on_days(days: Iterable[dt.date | None]) -> Column:
    days = set(days)
    day = F.col(schemas.BRONZE_DAY)
    dated = day.isin(sorted(d for d in days if d is not None)) if days - {None} else F.lit(False)
    return (dated | day.isNull()) if None in days else dated


def _stored(spark: SparkSession, lake: Lake, holder: str) -> DataFrame:
    return spark.read.schema(_STORED).parquet(place_of(lake, holder))


def _rows_by_file(
    spark: SparkSession, lake: Lake, holder: str, days: Iterable[dt.date | None]
) -> dict[str, tuple[int, list[str]]]:
    """Rows and day folders of each file, from one column of the folders just written."""
    folder = F.coalesce(F.col(schemas.BRONZE_DAY).cast("string"), F.lit(NO_DAY))
    rows = _stored(spark, lake, holder).where(_on_days(days) & F.col(schemas.SOURCE_FILE).isNotNull())
    by_day = rows.groupBy(schemas.SOURCE_FILE, folder.alias("folder")).agg(F.count(F.lit(1)).alias("n"))
    counted = by_day.groupBy(schemas.SOURCE_FILE).agg(
        F.sum("n").alias("n"), F.sort_array(F.collect_list("folder")).alias("folders")
    )
    return {r[0]: (r.n, r.folders) for r in counted.collect()}


def _evict(spark: SparkSession, lake: Lake, outdated: list[Row]) -> None:
    by_holder: dict[str, list[Row]] = defaultdict(list)
    for entry in outdated:
        by_holder[entry[schemas.HOLDER]].append(entry)
    for holder, entries in by_holder.items():
        paths = {e.file_path for e in entries}
        _rewrite_without(spark, lake, holder, entries, _days_with(spark, lake, holder, entries))
        rest = [e for e in entries_of(spark, lake, holder) if e.file_path not in paths]
        write_entries(spark, lake, holder, rest)


def _named(spark: SparkSession, entries: list[Row]) -> DataFrame:
    return spark.createDataFrame([(e.file_path,) for e in entries], f"{schemas.SOURCE_FILE} string")


def _days_with(spark: SparkSession, lake: Lake, holder: str, entries: list[Row]) -> set[dt.date | None]:
    """Days with rows of the files: from the ledger, or by a look where it does not say."""
    if all(e.day_folders is not None for e in entries):
        folders = {f for e in entries for f in e.day_folders}
        return {None if f == NO_DAY else dt.date.fromisoformat(f) for f in folders}
    rows = _stored(spark, lake, holder).join(_named(spark, entries), schemas.SOURCE_FILE, "left_semi")
    return {r[0] for r in rows.select(schemas.BRONZE_DAY).distinct().collect()}


def rows_of_others(spark: SparkSession, lake: Lake, batch: Batch, days: Iterable[dt.date | None]) -> DataFrame:
    """Rows of full builds on these days from files that the batch does not bring."""
    rows = _stored(spark, lake, BUILD).where(_on_days(days))
    return rows.join(_named(spark, batch.taken), schemas.SOURCE_FILE, "left_anti").select(*_STORED.names)


def _rewrite_without(
    spark: SparkSession, lake: Lake, holder: str, entries: list[Row], days: set[dt.date | None]
) -> None:
    """Takes the files' rows out of these days of the holder."""
    if not days:
        return
    place, day = place_of(lake, holder), F.col(schemas.BRONZE_DAY)
    stored, gone = _stored(spark, lake, holder).where(_on_days(days)), _named(spark, entries)
    rest = stored.join(gone, schemas.SOURCE_FILE, "left_anti")
    seen = Observation("rest")
    replace_days(
        rest.select(*_STORED.names),
        place,
        schemas.BRONZE_DAY,
        observation=seen,
        metrics=(F.collect_set(day).alias("days"), F.count_if(day.isNull()).alias("without_day")),
    )
    kept = set(seen.get.get("days") or []) | ({None} if seen.get.get("without_day") else set())
    for empty in days - kept:
        folder = f"{place}/{schemas.BRONZE_DAY}={_folder(empty)}"
        empty_folder(spark, T.StructType(_STORED.fields[:-1]), folder)
    table = lake.bronze if holder == BUILD else lake.bronze_loads
    spark.catalog.refreshTable(table.name)
