"""Event times: classification, zones, and the change filter.

Every function expects the session time zone to be UTC (see `pin_utc`). Local times and dates are read in
an explicit zone, never in that of the machine. Comparisons convert the literal to the column's type and
leave the column alone, so that they are pushed down to the scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime, timedelta
from enum import Enum
from zoneinfo import ZoneInfo, ZoneInfoNotFoundError

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class ContractError(ValueError):
    """A configuration or a table that doesn't meet its contract."""


class Temporal(Enum):
    DATE = "date"
    TIMESTAMP = "timestamp"
    TIMESTAMPTZ = "timestamptz"
    TIME = "time"
    TIMETZ = "timetz"
    INTERVAL = "interval"
    NONE = "none"

    @property
    def is_event_time(self) -> bool:
        return self in (Temporal.DATE, Temporal.TIMESTAMP, Temporal.TIMESTAMPTZ)

    @property
    def needs_zone(self) -> bool:
        return self in (Temporal.DATE, Temporal.TIMESTAMP)


def pin_utc(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def classify(kind: T.DataType | str) -> Temporal:
    """The temporal class of a Spark type or of a PostgreSQL type name."""
    if isinstance(kind, str):
        name = kind.strip().lower()
        # PostgreSQL's names of temporal types.
        names = {
            "date": Temporal.DATE,
            "timestamp": Temporal.TIMESTAMP,
            "timestamp without time zone": Temporal.TIMESTAMP,
            "timestamptz": Temporal.TIMESTAMPTZ,
            "timestamp with time zone": Temporal.TIMESTAMPTZ,
            "time": Temporal.TIME,
            "timetz": Temporal.TIMETZ,
            "interval": Temporal.INTERVAL,
        }
        return names.get(name, Temporal.NONE)
    if isinstance(kind, T.DateType):
        return Temporal.DATE
    if isinstance(kind, T.TimestampNTZType):
        return Temporal.TIMESTAMP
    if isinstance(kind, T.TimestampType):
        return Temporal.TIMESTAMPTZ
    if isinstance(kind, T.DayTimeIntervalType | T.YearMonthIntervalType | T.CalendarIntervalType):
        return Temporal.INTERVAL
    return Temporal.TIME if kind.simpleString().startswith("time(") else Temporal.NONE


def resolve_zone(own: str | None, default: str | None) -> str | None:
    """The table's zone, else the common one, else none; an unknown zone is an error."""
    for zone in (own, default):
        if zone and zone.strip():
            try:
                ZoneInfo(zone.strip())
            except (ZoneInfoNotFoundError, ValueError) as e:
                raise ContractError(f"unknown time zone {zone!r}") from e
            return zone.strip()
    return None


@dataclass(frozen=True)
class EventColumn:
    """A column that says when a row was made or changed."""

    name: str
    kind: Temporal
    zone: str | None = None

    def __post_init__(self):
        if not self.kind.is_event_time:
            raise ContractError(f"column {self.name!r} of type {self.kind.value} can't be an event time")
        if self.kind.needs_zone and not self.zone:
            raise ContractError(f"column {self.name!r} of type {self.kind.value} needs a source time zone")

    def instant(self) -> Column:
        """The column as an instant; a date is the start of its day in the zone. Spark's times are in microseconds."""
        c = F.col(self.name)
        if self.kind is Temporal.TIMESTAMPTZ:
            return c.cast("timestamp")
        return F.to_utc_timestamp(c.cast("timestamp_ntz"), self.zone).cast("timestamp")

    def newer_than(self, mark: datetime) -> Column:
        """Strictly later than the mark. For a date: a later local day than the mark's."""
        c, at = F.col(self.name), utc(mark)
        if self.kind is Temporal.TIMESTAMPTZ:
            return c > F.lit(at)
        local = at.astimezone(ZoneInfo(self.zone)).replace(tzinfo=None)
        return c > (F.lit(local.date()) if self.kind is Temporal.DATE else F.lit(local.isoformat(sep=" ")).cast("timestamp_ntz"))


def utc(moment: datetime) -> datetime:
    """A moment in UTC; one without a zone is taken as UTC."""
    return moment.replace(tzinfo=UTC) if moment.tzinfo is None else moment.astimezone(UTC)


def change_filter(created: EventColumn, updated: EventColumn | None, mark: datetime | None) -> Column:
    """Rows that are new since the mark: created later, or updated later. Without a mark, all that were created.

    A row without a creation time is never taken, whatever its update says.
    """
    made = F.col(created.name).isNotNull()
    if mark is None:
        return made
    newer = created.newer_than(mark)
    if updated is not None:
        newer = newer | (F.col(updated.name).isNotNull() & updated.newer_than(mark))
    return made & newer


def last_event(created: EventColumn, updated: EventColumn | None) -> Column:
    """The later of the two instants; null-safe."""
    return created.instant() if updated is None else F.greatest(created.instant(), updated.instant())


def is_due(last: datetime | None, now: datetime, every: timedelta = timedelta(hours=24)) -> bool:
    """Whether something done last at that time is due again. Never done: due."""
    return last is None or utc(now) - utc(last) > every
