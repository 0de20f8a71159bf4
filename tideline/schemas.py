"""Columns of every layer.

All names, types and orders here are fixed values: stored files and reports use them.
"""

from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField(name, T.StringType(), True)
        for name in (
            "event_time",
            "event_type",
            "product_id",
            "category_id",
            "category_code",
            "brand",
            "price",
            "user_id",
            "user_session",
        )
    ]
)

BRONZE_DAY = "event_date_utc"
BRONZE = T.StructType(RAW.fields + [T.StructField(BRONZE_DAY, T.DateType(), True)])

# Increments: the caller's key of a load, then the day.
LOAD_KEY = "load_key"
BRONZE_LOADS = T.StructType(
    RAW.fields
    + [T.StructField(LOAD_KEY, T.StringType(), True), T.StructField(BRONZE_DAY, T.DateType(), True)]
)

# Stored rows of source files also name their file; tables do not show the column.
SOURCE_FILE = "source_file"
# Source files in Bronze: who holds them, and the day folders that have rows of theirs.
HOLDER = "holder"
BRONZE_FILES = T.StructType(
    [
        T.StructField("file_path", T.StringType(), True),
        T.StructField("file_size", T.LongType(), True),
        T.StructField("file_time_ms", T.LongType(), True),
        T.StructField("rows", T.LongType(), True),
        T.StructField("day_folders", T.ArrayType(T.StringType()), True),
        T.StructField("whole", T.BooleanType(), True),
        T.StructField(HOLDER, T.StringType(), True),
    ]
)

SILVER_DAY = "event_date_kst"
SILVER = T.StructType(
    [
        T.StructField("event_time_utc", T.TimestampType(), True),
        T.StructField("event_time_kst", T.TimestampType(), True),
        T.StructField("event_type", T.StringType(), True),
        T.StructField("product_id", T.LongType(), True),
        T.StructField("category_id", T.LongType(), True),
        T.StructField("category_code", T.StringType(), True),
        T.StructField("brand", T.StringType(), True),
        T.StructField("price", T.DoubleType(), True),
        T.StructField("user_id", T.LongType(), True),
        T.StructField("source_user_session", T.StringType(), True),
        T.StructField("session_id", T.StringType(), True),
        T.StructField("session_start_utc", T.TimestampType(), True),
        T.StructField(SILVER_DAY, T.DateType(), True),
    ]
)

GOLD_WEEK = "week_start_date"
# Gold's files lie in a folder a week, which is no column of the table.
GOLD_FOLDER = "week"
GOLD = T.StructType(
    [
        T.StructField(GOLD_WEEK, T.DateType(), True),
        T.StructField("wau_by_user", T.LongType(), True),
        T.StructField("wau_by_session", T.LongType(), True),
    ]
)

# The state that distinct counts are made from.
NUMBERS_BATCH = "batch"
USER_NUMBERS = T.StructType(
    [
        T.StructField("user_id", T.LongType(), True),
        T.StructField("number", T.LongType(), True),
        T.StructField(NUMBERS_BATCH, T.StringType(), True),
    ]
)
USER_DAYS = T.StructType(
    [
        T.StructField("bucket", T.LongType(), True),
        T.StructField("users", T.BinaryType(), True),
        T.StructField(SILVER_DAY, T.DateType(), True),
    ]
)
SESSION_DAYS = T.StructType(
    [
        T.StructField("day_before", T.DateType(), True),
        T.StructField("sessions", T.LongType(), True),
        T.StructField(SILVER_DAY, T.DateType(), True),
    ]
)

AUDIT = T.StructType(
    [
        T.StructField("run_id", T.StringType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("input_path", T.StringType(), True),
        T.StructField("output_path", T.StringType(), True),
        T.StructField("target_start_date", T.StringType(), True),
        T.StructField("target_end_date", T.StringType(), True),
        T.StructField("row_count", T.LongType(), True),
        T.StructField("started_at", T.StringType(), True),
        T.StructField("finished_at", T.StringType(), True),
        T.StructField("error_message", T.StringType(), True),
        # Records of earlier runs have none of these, and read as null.
        T.StructField("expected_days", T.ArrayType(T.StringType()), True),
        T.StructField("written_days", T.ArrayType(T.StringType()), True),
        T.StructField("lost_values", T.MapType(T.StringType(), T.LongType()), True),
    ]
)
