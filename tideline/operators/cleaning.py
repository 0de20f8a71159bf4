"""Raw text rows -> typed rows -> rows that can be sessionized.

Every step keeps columns it does not know, so a row key survives to the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tideline import schemas
from tideline.functions import (
    kst_wall_clock,
    parse_event_time,
    to_bigint,
    to_double,
    utc_day,
)
from tideline.functions.clock import LOCAL_ZONE


def with_utc_day(raw: DataFrame, time_format: str | None = None) -> DataFrame:
    """Adds the Bronze partition day; null where the time cannot be read."""
    return raw.withColumn(
        schemas.BRONZE_DAY, utc_day(parse_event_time(F.col("event_time"), time_format))
    )


def lost_values() -> dict[str, Column]:
    """Conditions on raw rows with their day, by column and reason, under which a value is null
    once typed:
    ``missing`` where there is none, ``unreadable`` where there is one. Without a time or a
    user the row gets no place in Silver; other columns are null there."""
    read = {
        "event_time": F.col(schemas.BRONZE_DAY),
        "user_id": to_bigint(F.col("user_id")),
        "product_id": to_bigint(F.col("product_id")),
        "category_id": to_bigint(F.col("category_id")),
        "price": to_double(F.col("price")),
    }
    missing = {f"{c}:missing": F.col(c).isNull() for c in read}
    unreadable = {f"{c}:unreadable": F.col(c).isNotNull() & v.isNull() for c, v in read.items()}
    return {**missing, **unreadable}


def typed_events(raw: DataFrame, time_format: str | None = None) -> DataFrame:
    """Types the nine raw columns. Bad values become null; no row is dropped."""
    others = [c for c in raw.columns if c not in schemas.RAW.names]
    return raw.select(
        *others,
        parse_event_time(F.col("event_time"), time_format).alias("event_time_utc"),
        "event_type",
        to_bigint(F.col("product_id")).alias("product_id"),
        to_bigint(F.col("category_id")).alias("category_id"),
        "category_code",
        "brand",
        to_double(F.col("price")).alias("price"),
        to_bigint(F.col("user_id")).alias("user_id"),
        F.col("user_session").alias("source_user_session"),
    )


def clean_events(typed: DataFrame, zone: str = LOCAL_ZONE) -> DataFrame:
    """Drops rows without time or user and adds the local clock and day."""
    local = kst_wall_clock(F.col("event_time_utc"), zone)
    return typed.filter(
        F.col("event_time_utc").isNotNull() & F.col("user_id").isNotNull()
    ).withColumns(
        {"event_time_kst": local, schemas.SILVER_DAY: F.to_date(local)}
    )
