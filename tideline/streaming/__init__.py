from tideline.streaming.arrivals import stream_into_lake, take_in
from tideline.streaming.sessions import (
    closed_sessions,
    read_closed_sessions,
    read_raw_stream,
    store_closed_sessions,
)

__all__ = [
    "closed_sessions",
    "read_closed_sessions",
    "read_raw_stream",
    "store_closed_sessions",
    "stream_into_lake",
    "take_in",
]
