"""Plain Python session cut, to compare with."""

from __future__ import annotations

import datetime as dt
from collections import defaultdict

EPOCH = dt.datetime(1970, 1, 1)


def whole(t: dt.datetime) -> int:
    return (t - EPOCH) // dt.timedelta(seconds=1)


def cut(rows, gap: int):
    """rows: (key, user, time, type, product) -> key: (prev, flag, number, start)."""
    per_user = defaultdict(list)
    for row in rows:
        per_user[row[1]].append(row)
    found = {}
    for own in per_user.values():
        own.sort(
            key=lambda r: (
                r[2],
                (r[3] is not None, r[3] or ""),
                (r[4] is not None, r[4] or 0),
                r[0],
            )
        )
        before, number, start = None, 0, None
        for key, _, time, _, _ in own:
            flag = int(before is None or whole(time) - whole(before) >= gap)
            if flag:
                number, start = number + 1, time
            found[key] = (before, flag, number, start)
            before = time
    return found
