from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from tideline.sinks.catalog import CLUSTERED_BY, MAX_ROWS_PER_FILE, LayerTable


def replace_days(
    df: DataFrame,
    path: str,
    day_column: str,
    max_rows_per_file: int = MAX_ROWS_PER_FILE,
    observation: Observation | None = None,
    metrics: tuple[Column, ...] = (),
) -> None:
    """Writes day partitions; days that ``df`` does not hold stay as they are.

    The overwrite mode is set on the write, since a session's default would delete
    all other days. Rows are gathered by day against small files, in a way that lets
    adaptive execution split a big day over several tasks. Metrics are observed after
    that shuffle, in the writing stage, so a map task run again for a lost executor
    is not counted twice.
    """
    _write_days(df, path, day_column, "dynamic", max_rows_per_file, observation, metrics)


def replace_load(
    df: DataFrame,
    path: str,
    day_column: str,
    max_rows_per_file: int = MAX_ROWS_PER_FILE,
    observation: Observation | None = None,
    metrics: tuple[Column, ...] = (),
) -> None:
    """The same, but everything under ``path`` is replaced, days that ``df`` lacks too."""
    _write_days(df, path, day_column, "static", max_rows_per_file, observation, metrics)


def _write_days(df, path, day_column, overwrite, max_rows_per_file, observation, metrics):
    gathered = df.hint("rebalance", day_column)
    if observation is not None:
        gathered = gathered.observe(observation, *metrics)
    (
        gathered.write.mode("overwrite")
        .option("partitionOverwriteMode", overwrite)
        .option("compression", "snappy")
        .option("maxRecordsPerFile", max_rows_per_file)
        .partitionBy(day_column)
        .parquet(path)
    )


def replace_clustered_days(
    df: DataFrame,
    table: LayerTable,
    day_column: str,
    observation: Observation | None = None,
    metrics: tuple[Column, ...] = (),
) -> None:
    """``replace_days`` of a table with buckets, through the catalog, which also learns of the
    days. Rows are gathered by day and bucket; adaptive execution splits a big bucket over
    several tasks, which then has several files."""
    user, columns = CLUSTERED_BY[0], df.columns
    bucket = F.pmod(F.hash(user), F.lit(table.buckets))
    gathered = df.withColumn("_bucket", bucket).hint("rebalance", day_column, "_bucket").select(*columns)
    if observation is not None:
        gathered = gathered.observe(observation, *metrics)
    gathered.write.mode("overwrite").insertInto(table.name)


def empty_folder(spark: SparkSession, schema: StructType, path: str) -> None:
    """Leaves no rows in one partition's folder, which a dynamic overwrite cannot do."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
