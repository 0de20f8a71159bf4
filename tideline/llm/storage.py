"""Shared folders for what an operator writes between its steps."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the session's `spark.checkpoint.dir`, which driver and
    executors share; without that setting, under the warehouse, which they share too."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = f"{spark.catalog.getDatabase('default').locationUri.rstrip('/')}/scratch"
    if base.startswith("file:/") and not base.startswith("file://"):
        base = "file://" + base.removeprefix("file:")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The rows of `df`, written to a shared folder and read again: lineage is cut, and
    losing an executor repeats nothing that came before."""
    spark = df.sparkSession
    path = shared_folder(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


#: Most rows, of a few numbers each, that are sent whole to every task.
BROADCAST_ROWS = 1_000_000


def sized(rows: DataFrame) -> DataFrame:
    """A written table of narrow rows for the small side of a join: marked for broadcast
    if counting shows no more than `BROADCAST_ROWS`, else left for a join by shuffle."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows
