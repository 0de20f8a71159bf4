"""Catalog tables over Parquet files that outlive them."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import SparkSession, functions as F
from pyspark.sql.types import StructType


# Fixed value: the default cap on rows per file.
MAX_ROWS_PER_FILE = 1_000_000
# The column that clustered tables are bucketed by, and the order in a bucket.
CLUSTERED_BY = ("user_id", "event_time_utc")


@dataclass(frozen=True)
class LayerTable:
    """A table name and the place of its files (any Hadoop path). With ``buckets``, files of
    each partition are clustered by user into so many, and sorted in each. With ``versioned``,
    the days of a run are published together (``sinks.versions``)."""

    database: str
    table: str
    path: str
    buckets: int = 0
    versioned: bool = False

    def __post_init__(self) -> None:
        if self.buckets and self.versioned:
            raise ValueError("a table is clustered or versioned, not both")

    @property
    def name(self) -> str:
        return f"`{self.database}`.`{self.table}`"


def create_database(spark: SparkSession, database: str) -> None:
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": database})


def create_layer_table(
    spark: SparkSession,
    table: LayerTable,
    schema: StructType,
    partition_columns: str | tuple[str, ...] = (),
    any_folder: bool = False,
) -> None:
    """Creates the database and an external Parquet table, if they are missing.

    ``any_folder``: the table's files lie in folders under its place that are no partitions.

    A table that is new to the catalog gets the partitions its folder already has, which
    is the only time that the folder is listed. A table of this name with files in another
    place is refused.
    """
    create_database(spark, table.database)
    if spark.catalog.tableExists(table.name):
        check_place(spark, table)
        return
    parts = (partition_columns,) if isinstance(partition_columns, str) else partition_columns
    if parts:
        # Partitions can only be looked for in a folder that exists; this adds no rows.
        no_rows = spark.range(0).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        )
        no_rows.write.mode("append").partitionBy(*parts).parquet(table.path)
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    names = ", ".join(f"`{p}`" for p in parts)
    partitioning = f"PARTITIONED BY ({names})" if parts else ""
    clustering = ""
    if table.buckets:
        sorting = ", ".join(f"`{c}`" for c in CLUSTERED_BY)
        clustering = f"CLUSTERED BY (`{CLUSTERED_BY[0]}`) SORTED BY ({sorting}) INTO {table.buckets} BUCKETS"
    options = "OPTIONS (recursiveFileLookup 'true')" if any_folder else ""
    if table.buckets:  # a write through the catalog takes these from the table
        options = f"OPTIONS (partitionOverwriteMode 'dynamic', maxRecordsPerFile '{MAX_ROWS_PER_FILE}')"
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table.name} ({columns}) USING parquet {options} "
        f"{partitioning} {clustering} LOCATION {quoted(table.path)} "
        "TBLPROPERTIES ('parquet.compression' = 'SNAPPY')"
    )
    if parts:
        repair_partitions(spark, table)


def quoted(text: str) -> str:
    """A string literal of SQL."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def plain_place(location: str) -> str:
    """A path without its scheme's empty authority and without a last slash."""
    return location.replace(":///", ":/").removeprefix("file:").rstrip("/")


def check_place(spark: SparkSession, table: LayerTable) -> None:
    """Raises if the catalog's table of this name has its files elsewhere."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table.name}").filter("col_name = 'Location'")
    found = rows.first()["data_type"]
    if plain_place(found) != plain_place(table.path):
        raise ValueError(f"{table.name} has its files in {found}, not in {table.path}")


def repair_partitions(spark: SparkSession, table: LayerTable) -> None:
    """Lists the whole folder and makes its partitions known: for files that came from
    elsewhere. Runs register what they wrote instead."""
    spark.sql(f"MSCK REPAIR TABLE {table.name}")
    spark.catalog.refreshTable(table.name)


def partition_spec(partition: dict[str, str | dt.date | None]) -> str:
    values = [
        f"`{k}` = " + ("null" if v is None else "'" + str(v).replace("'", "\\'") + "'")
        for k, v in partition.items()
    ]
    return f"PARTITION ({', '.join(values)})"


def register_partitions(
    spark: SparkSession, table: LayerTable, partitions: Iterable[dict[str, str | dt.date | None]]
) -> None:
    """Makes written partitions known to the catalog and drops stale file listings."""
    specs = [partition_spec(p) for p in partitions]
    for at in range(0, len(specs), 100):
        spark.sql(f"ALTER TABLE {table.name} ADD IF NOT EXISTS {' '.join(specs[at : at + 100])}")
    spark.catalog.refreshTable(table.name)


def register_days(
    spark: SparkSession, table: LayerTable, day_column: str, days: Iterable[dt.date | None]
) -> None:
    """The same for days; None is the partition of rows without a day."""
    register_partitions(spark, table, [{day_column: day} for day in days])


def forget_partitions(
    spark: SparkSession, table: LayerTable, partitions: Iterable[dict[str, str | dt.date | None]]
) -> None:
    """Takes partitions out of the catalog; their files are not looked at."""
    for partition in partitions:
        spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS {partition_spec(partition)}")


def known_days(spark: SparkSession, table: LayerTable, day_column: str) -> set[dt.date]:
    """Days that have a partition, from the catalog alone."""
    names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {table.name}").collect()]
    texts = {part.partition("=")[2] for n in names for part in n.split("/") if part.startswith(f"{day_column}=")}
    return {dt.date.fromisoformat(t) for t in texts if t[:1].isdigit()}
