"""Reads of the stored layers, by catalog name."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from tideline import schemas
from tideline.operators.ranges import days_between


def read_bronze(spark: SparkSession, *tables: str) -> DataFrame:
    """All Bronze rows of those of the tables that exist."""
    found = [spark.table(t).select(*schemas.BRONZE.names) for t in tables if spark.catalog.tableExists(t)]
    if not found:
        raise ValueError(f"none of these tables exists: {', '.join(tables)}")
    return reduce(DataFrame.union, found)


def read_bronze_range(
    spark: SparkSession,
    tables: str | Sequence[str],
    start: str | dt.date,
    end: str | dt.date,
    buffer_days: int = 0,
) -> DataFrame:
    """Bronze rows of the UTC days from ``start - buffer_days`` to ``end``, both in.

    The bounds are plain date literals on the partition column, so only those
    directories are listed and read. Rows without a readable time are never in range.
    """
    names = [tables] if isinstance(tables, str) else tables
    return days_between(read_bronze(spark, *names), schemas.BRONZE_DAY, start, end, buffer_days)


def read_silver(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table)


def read_gold(spark: SparkSession, table: str) -> DataFrame:
    return spark.table(table).orderBy(schemas.GOLD_WEEK)
