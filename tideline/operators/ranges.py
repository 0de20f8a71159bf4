from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, functions as F

from tideline.functions.clock import checked_range, day_literal


def days_between(
    df: DataFrame,
    day_column: str,
    start: str | dt.date,
    end: str | dt.date,
    buffer_days: int = 0,
) -> DataFrame:
    """Rows whose day lies in ``[start - buffer_days, end]``."""
    first, last = checked_range(start, end)
    if buffer_days < 0:
        raise ValueError("buffer_days must not be negative")
    return df.filter(
        F.col(day_column).between(
            day_literal(first - dt.timedelta(days=buffer_days)), day_literal(last)
        )
    )
