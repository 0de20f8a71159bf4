"""The `events` table as raw click-stream rows, with the dirt raw files have.

The table is clean, so some fields are spoilt by rule: the row is kept, and the rules
are the same ones in ``RAW_SQL``. No row is left out by them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tideline.operators.cleaning import clean_events, typed_events


def table(spark: SparkSession, sf_dir: str, name: str = "events") -> DataFrame:
    # Times are stored without a zone; reading them as UTC needs a UTC session.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, text = F.col("event_id"), lambda c: c.cast("string")

    def every(n: int):
        return key % n == 0

    return table(spark, sf_dir).select(
        "event_id",
        F.when(every(97), "not-a-time")
        .otherwise(F.concat(text(F.date_trunc("second", "ts")), F.lit(" UTC")))
        .alias("event_time"),
        "event_type",
        F.get_json_object("props", "$.k").alias("product_id"),
        F.when(every(83), "").otherwise(text(key % 25)).alias("category_id"),
        F.when(~every(5), F.concat(F.lit("cat."), text(key % 7))).alias("category_code"),
        F.when(~every(3), F.concat(F.lit("brand"), text(key % 11))).alias("brand"),
        text(F.col("value")).alias("price"),
        F.concat(F.when(every(89), "u").otherwise(""), text(F.col("user_id"))).alias(
            "user_id"
        ),
        F.concat_ws("-", text(F.col("user_id")), text(F.to_date("ts"))).alias(
            "user_session"
        ),
    )


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return typed_events(raw_events(spark, sf_dir))


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_events(typed(spark, sf_dir))


def exact_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean events straight from the table, with its microseconds."""
    return clean_events(
        table(spark, sf_dir).select(
            "event_id",
            F.col("ts").cast("timestamp").alias("event_time_utc"),
            "event_type",
            F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
            "user_id",
        )
    )


def heavy_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a third of all rows on one user."""
    return exact_clean(spark, sf_dir).withColumn(
        "user_id", F.when(F.col("event_id") % 3 == 0, 0).otherwise(F.col("user_id"))
    )
