from __future__ import annotations

from dataclasses import dataclass

from tideline.sinks.catalog import LayerTable


@dataclass(frozen=True)
class Lake:
    """Names and places of the layers. ``audit_path`` may be None: no run records.

    Bronze has two tables: one that full builds replace, and one of increments by load key.
    ``bronze_files`` is the ledger of source files; without it files are not told apart.
    Gold needs a folder of its own, with nothing in it but its weeks. The last three hold
    the state of ``plans.activity_state``.
    """

    bronze: LayerTable
    bronze_loads: LayerTable
    silver: LayerTable
    gold: LayerTable
    audit_path: str | None = None
    bronze_files: LayerTable | None = None
    user_numbers: LayerTable | None = None
    user_days: LayerTable | None = None
    session_days: LayerTable | None = None

    @classmethod
    def under(
        cls, root: str, database: str, user_buckets: int = 0, versioned_silver: bool = False
    ) -> Lake:
        """``user_buckets``: Silver is clustered by user into so many files a day, so that
        looking back by user does not shuffle it. All of a user's rows of the days read then
        meet in one task; leave it out where a user can have a large part of all rows.
        ``versioned_silver``: all days that a run writes to Silver are published together."""
        root = root.rstrip("/")

        def layer(table: str) -> LayerTable:
            return LayerTable(database, table, f"{root}/{table}")

        return cls(
            bronze=layer("bronze_events"),
            bronze_loads=layer("bronze_event_loads"),
            silver=LayerTable(
                database, "silver_events", f"{root}/silver_events", user_buckets, versioned_silver
            ),
            gold=LayerTable(database, "gold_weekly_activity", f"{root}/gold_weekly_activity/weeks"),
            audit_path=f"{root}/run_audit",
            bronze_files=layer("bronze_files"),
            user_numbers=layer("state_user_numbers"),
            user_days=layer("state_user_days"),
            session_days=layer("state_session_days"),
        )
