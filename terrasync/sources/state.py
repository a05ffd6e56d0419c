"""The state of incremental runs: one row for each sync key."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = (
    "sync_key string, source_table string, watermark_last_event_at timestamp, last_success_at timestamp, "
    "last_job_execution_id bigint, last_orphan_check_at timestamp, updated_at timestamp"
)
TABLE = "batch/sync_state"


@dataclass(frozen=True)
class SyncState:
    sync_key: str
    source_table: str | None = None
    watermark_last_event_at: datetime | None = None
    last_success_at: datetime | None = None
    last_job_execution_id: int | None = None
    last_orphan_check_at: datetime | None = None
    updated_at: datetime | None = None


def find(states: DataFrame | None, key: str) -> SyncState | None:
    row = states.where(F.col("sync_key") == key).first() if states is not None else None
    return SyncState(**row.asDict()) if row else None


def _put(states: DataFrame, key: str, source: str, now: datetime, **new) -> DataFrame:
    """The row of a key with new values; a None keeps the old value, as do columns that aren't named."""
    spark = states.sparkSession
    row = {"sync_key": key, "source_table": source, "updated_at": now, **new}
    fresh = spark.createDataFrame([tuple(row.get(f.name) for f in states.schema)], states.schema)
    old = states.where(F.col("sync_key") == key).select("sync_key", *(F.col(c).alias(f"old_{c}") for c in states.columns if c != "sync_key"))
    kept = [F.coalesce(c, f"old_{c}").alias(c) if c != "sync_key" else F.col(c) for c in states.columns]
    return states.where(F.col("sync_key") != key).unionByName(fresh.join(old, "sync_key", "left").select(*kept))


def advance(states: DataFrame, key: str, source: str, mark: datetime | None, execution: int, now: datetime) -> DataFrame:
    """After a successful run; the time of the last orphan check stays."""
    return _put(states, key, source, now, watermark_last_event_at=mark, last_success_at=now, last_job_execution_id=execution)


def mark_orphan_check(states: DataFrame, key: str, source: str, now: datetime) -> DataFrame:
    return _put(states, key, source, now, last_orphan_check_at=now)
