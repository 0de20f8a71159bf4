"""Fresh folders and databases for queries that write before they read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tideline.plans.lake import Lake


def scratch_dir(spark: SparkSession) -> str:
    """A new folder in the session's warehouse, which all executors share. It is removed
    when the driver JVM ends."""
    warehouse = spark.catalog.getDatabase("default").locationUri
    folder = f"{warehouse.rstrip('/')}/scratch-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def scratch_lake(spark: SparkSession, user_buckets: int = 0, versioned_silver: bool = False) -> Lake:
    """A lake of its own, in the folder that the warehouse gives its database."""
    database = f"tideline_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE `{database}`")
    root = f"{spark.catalog.getDatabase(database).locationUri}/lake"
    return Lake.under(root, database, user_buckets, versioned_silver)


def drop_lake(spark: SparkSession, lake: Lake) -> None:
    """Drops the tables from the catalog; their files stay."""
    spark.sql(f"DROP DATABASE IF EXISTS `{lake.silver.database}` CASCADE")


def stored(spark: SparkSession, df: DataFrame, folder: str) -> DataFrame:
    """Writes a result and reads it back, so that it outlives the tables under it."""
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
