"""The ledger of accepted tasks as a table."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..constants import ACCEPTED, LEDGER_CLEANUP_BATCH, LEDGER_MAX_AGE
from ..functions.durations import to_micros
from ..functions.hashing import content_changed, name_uuid


def latest_per_key(ledger: DataFrame, key: str = "task_key", at: str = "created_at", tie: list[str] | None = None) -> DataFrame:
    """The newest record of each key.

    The rank filter is applied before the shuffle too, so a key with very many
    records sends one per map task.
    """
    newest = Window.partitionBy(key).orderBy(F.col(at).desc(), *(F.col(c).desc() for c in tie or []))
    return ledger.withColumn("_rank", F.row_number().over(newest)).filter("_rank = 1").drop("_rank")


def changed_since_last(events: DataFrame, last: DataFrame, key: str = "task_key") -> DataFrame:
    """Events with ``changed``: differs from the key's last record (NULL without one)."""
    known = last.select(key, F.col("event_uid").alias("_uid"), F.col("content_hash").alias("_hash"), F.lit(True).alias("_known"))
    changed = content_changed(F.col("_uid"), F.col("_hash"), F.col("event_uid"), F.col("content_hash"))
    return events.join(known, key, "left").withColumn("changed", F.when(F.col("_known"), changed)).drop("_uid", "_hash", "_known")


def ledger_records(admitted: DataFrame, key: str = "task_key") -> DataFrame:
    """The tasks an admission run created, with a repeatable id."""
    task_id = name_uuid(F.concat_ws("|", F.col(key), F.unix_micros("created_at").cast("string"), F.col("event_uid")))
    return admitted.filter(F.col("status") == ACCEPTED).drop("status").withColumn("task_id", task_id)


def due_tasks(ledger: DataFrame, now: Column) -> DataFrame:
    """Tasks whose time to run has come."""
    return ledger.filter(F.col("scheduled_at") <= now)


def expire_ledger(ledger: DataFrame, now: Column) -> DataFrame:
    """The records worth keeping: not past their own expiry."""
    return ledger.filter(F.col("expire_at") > now)


def cleanup_batch(
    ledger: DataFrame, now: Column, max_age: timedelta = LEDGER_MAX_AGE, size: int = LEDGER_CLEANUP_BATCH
) -> DataFrame:
    """The next bounded batch of records to remove, oldest first."""
    old = F.unix_micros("created_at") < F.unix_micros(now) - F.lit(to_micros(max_age))
    return bounded_batch(ledger.filter(old), ["created_at", "task_key"], size)


def bounded_batch(df: DataFrame, order: list[str], size: int) -> DataFrame:
    """At most ``size`` rows, in order."""
    return df.orderBy(*order).limit(size)
