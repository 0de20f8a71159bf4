"""Run records: every status change of a run is one appended row."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tideline import schemas
from tideline.functions.clock import LOCAL_ZONE


def _now(zone: str) -> dt.datetime:
    return dt.datetime.now(ZoneInfo(zone))


def new_run_id(zone: str = LOCAL_ZONE) -> str:
    return _now(zone).strftime("%Y%m%d_%H%M%S")


@dataclass
class RunRecord:
    # The names of the stored fields.
    run_id: str
    status: str
    input_path: str
    output_path: str
    target_start_date: str | None
    target_end_date: str | None
    row_count: int | None = None
    started_at: str | None = None
    finished_at: str | None = None
    error_message: str | None = None
    # Days the run was asked for and those it had rows on, and how many values of each column
    # could not be kept, by reason. Null where a run has no such thing.
    expected_days: list[str] | None = None
    written_days: list[str] | None = None
    lost_values: dict[str, int] | None = None

    def wrote(self, days: Iterable[dt.date | None]) -> None:
        """Notes the days; rows without a day count as the day ``none``."""
        self.written_days = ["none" if d is None else d.isoformat() for d in days]


def _literal(value: object) -> Column:
    if isinstance(value, list):
        return F.array(*map(F.lit, value))
    if isinstance(value, dict):
        return F.create_map(*[F.lit(x) for pair in value.items() for x in pair])
    return F.lit(value)


def append_record(spark: SparkSession, path: str, record: RunRecord) -> None:
    values = asdict(record)
    row = [_literal(values[f.name]).cast(f.dataType).alias(f.name) for f in schemas.AUDIT]
    # A folder for each record: runs at the same time never share a commit.
    folder = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    spark.range(1).coalesce(1).select(*row).write.json(folder)


def _days(start: dt.date, end: dt.date) -> list[str]:
    return [(start + dt.timedelta(days=n)).isoformat() for n in range((end - start).days + 1)]


@contextmanager
def recorded_run(
    spark: SparkSession,
    path: str | None,
    run_id: str | None,
    input_path: str,
    output_path: str,
    start: dt.date | None = None,
    end: dt.date | None = None,
    zone: str = LOCAL_ZONE,
) -> Iterator[RunRecord]:
    """Records RUNNING, then SUCCESS with ``row_count`` or FAILED with the message.

    Pass a run id of your own where runs may start within the same second. Without a
    path nothing is recorded.
    """

    def stamp() -> str:
        return _now(zone).isoformat(timespec="microseconds")

    record = RunRecord(
        run_id=run_id or new_run_id(zone),
        status="RUNNING",
        input_path=input_path,
        output_path=output_path,
        target_start_date=start.isoformat() if start else None,
        target_end_date=end.isoformat() if end else None,
        started_at=stamp(),
        expected_days=_days(start, end) if start and end else None,
    )

    def save() -> None:
        if path is not None:
            append_record(spark, path, record)

    save()
    try:
        yield record
    except Exception as error:
        record.status, record.error_message = "FAILED", str(error)
        record.row_count, record.finished_at = None, stamp()
        record.written_days = record.lost_values = None
        save()
        raise
    record.status, record.finished_at = "SUCCESS", stamp()
    save()


def read_audit(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.AUDIT).option("recursiveFileLookup", True).json(path)


def latest_status(audit: DataFrame) -> DataFrame:
    """The newest record of each run. Stamps share one form, so they sort as text."""
    newest = F.struct(
        F.coalesce("finished_at", "started_at"), F.col("finished_at").isNotNull()
    )
    return (
        audit.groupBy("run_id")
        .agg(F.max_by(F.struct(*schemas.AUDIT.names[1:]), newest).alias("last"))
        .select("run_id", "last.*")
    )


def days_without_rows(latest: DataFrame) -> DataFrame:
    """(run_id, day) of days that a finished run was asked for and had no rows on: its older
    partitions of these days, if any, stayed."""
    missed = F.array_except("expected_days", "written_days")
    return latest.where("status = 'SUCCESS'").select("run_id", F.explode(missed).alias("day"))
