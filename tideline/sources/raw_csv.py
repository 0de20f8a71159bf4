from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tideline import schemas


def read_raw_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    header: bool = True,
    schema: StructType = schemas.RAW,
) -> DataFrame:
    """Raw events from a CSV directory, or from several (day-wise increments).

    Everything is text and columns go by position: names in the header line are not
    looked at, short rows end in nulls, extra fields are dropped, empty is null.
    """
    return (
        spark.read.schema(schema)
        .option("header", header)
        .option("inferSchema", False)
        .option("enforceSchema", True)
        .option("mode", "PERMISSIVE")
        .csv([paths] if isinstance(paths, str) else list(paths))
    )
