from tideline.functions.clock import (
    epoch_seconds,
    kst_wall_clock,
    utc_day,
    week_start,
)
from tideline.functions.parsing import parse_event_time, to_bigint, to_double

__all__ = [
    "epoch_seconds",
    "kst_wall_clock",
    "parse_event_time",
    "to_bigint",
    "to_double",
    "utc_day",
    "week_start",
]
