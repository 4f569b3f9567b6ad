"""From event to loaded table: ingest, route, admit, run what is due, forget what expired.

Tables below the state folder:

- ``ledger``: accepted tasks by day of acceptance and micro-batch. A batch opens only the days
  inside its look-back; the batches of a closed day are compacted into one, which keeps the
  last record of each key and what is still to run.
- ``decisions``: the answer to every event, by the same two.
- ``runs`` and ``refused``: tasks that were loaded, or whose path was not what their rule
  needs, by day of the task and batch.
- ``clock``: one row for each of the last two batches: event time so far, the arrival time that
  stands in for events without a time, the longest life of a task and the longest delay.
- ``rejected``, ``nameless``: events set aside, by batch.

All are written by dynamic overwrite with given schemas, and a batch reads only what earlier
batches wrote. A batch that is run again after a failure therefore replaces its own traces, and
loads replace partitions, so running them twice is harmless. After each batch the days of
which every task has expired are removed. A timer, a stream of its own, runs tasks when they
fall due without a further event.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..constants import DEFAULT_COOLDOWN, DEFAULT_DELAY, DEFAULT_DOUBLE_TAP, DEFAULT_TTL, LATE
from ..functions.durations import iso_duration_micros, window_or_default
from ..functions.hashing import content_hash
from ..functions.paths import event_uid, is_manual, strip_filename, task_key_full
from ..functions.text import render_args, set_arg
from ..operators.admission import admit, window_columns
from ..operators.classify import resolve_input_path
from ..operators.ledger import due_tasks, latest_per_key, ledger_records
from ..operators.routing import nameless_events, route_events
from ..plans.load import LoadSpec, run_load
from ..sinks.storage import Folder
from ..sources.events import parse_events, rejected_records, valid_events
from .ingest import event_stream

WINDOW_COLUMNS = ("double_tap_window", "cooldown_window", "ttl_buffer", "schedule_delay")

DAY = "day"
# Events without a task have no day.
NO_DAY = "none"
SCHEMAS = {
    "task": "job string, mode string, bucket string, name string, at timestamp, task_key string, event_uid string, "
    "content_hash string, source string, force_run boolean, double_tap_window bigint, cooldown_window bigint, "
    "ttl_buffer bigint, schedule_delay bigint, created_at timestamp, scheduled_at timestamp, cooldown_until timestamp, "
    "expire_at timestamp",
    "runs": "task_id string, job string, bucket string, path string, args array<string>, created_at timestamp",
    "refused": "task_id string, job string, bucket string, name string, error string, created_at timestamp",
}
REFUSED_COLUMNS = ("task_id", "job", "bucket", "name", "error", "created_at")
CLOCK = "batch_id bigint, arrived bigint, before bigint, tick bigint, life bigint, delay bigint"


class Clock(NamedTuple):
    """What a batch knows of time, in microseconds."""

    batch_id: int
    arrived: int
    # Event time up to the batch before, and up to this one.
    before: int | None
    tick: int | None
    life: int
    delay: int


def day_name(micros: int) -> str:
    return (datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)).strftime("%Y-%m-%d")


def day_end(day: str) -> int:
    end = datetime.strptime(day, "%Y-%m-%d").replace(tzinfo=timezone.utc) + timedelta(days=1)
    return (end - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)


@dataclass
class ContinuousLoad:
    """``rules`` carry their windows as ISO durations; ``loads`` maps rules to loads."""

    spark: SparkSession
    state: str
    rules: DataFrame
    loads: dict[str, LoadSpec]
    locate: Callable[[str, str], str]
    manifest: DataFrame | None = None
    # Turns a micro-batch's tasks into loads; off leaves them to someone else.
    run_due: bool = True
    options: dict = field(default_factory=dict)

    def start(self, events_path: str, files_per_trigger: int | None = None) -> StreamingQuery:
        return (
            event_stream(self.spark, events_path, files_per_trigger)
            .writeStream.foreachBatch(self.process)
            .option("checkpointLocation", f"{self.state}/checkpoint")
            .trigger(**(self.options or {"availableNow": True}))
            .start()
        )

    def start_timer(self, interval: str = "10 seconds") -> StreamingQuery:
        """Run due tasks by the wall clock, whether events come or not.

        Set ``run_due`` off beside it, so that one stream alone runs tasks.
        """
        ticks = self.spark.readStream.format("rate").option("rowsPerSecond", 1).load()
        return (
            ticks.writeStream.foreachBatch(lambda batch, _: self.run_tasks(datetime.now(timezone.utc)))
            .option("checkpointLocation", f"{self.state}/timer-checkpoint")
            .trigger(processingTime=interval)
            .start()
        )

    def process(self, batch: DataFrame, batch_id: int) -> None:
        clock = self._begin(batch_id)
        parsed = parse_events(batch)
        events = valid_events(parsed)
        self._write(rejected_records(parsed), "rejected", batch_id)
        self._write(nameless_events(events, self.rules), "nameless", batch_id)
        self._write_days(self.decide(events, batch_id, clock), "decisions", batch_id)
        decided = self._days("decisions", batch=batch_id)
        tick = None
        if decided is not None:
            self._write_days(ledger_records(decided.drop("day", "batch_id")), "ledger", batch_id)
            tick = decided.agg(F.unix_micros(F.max("at")).alias("t")).head().t
        clock = self._tick(clock, max(x for x in (tick, clock.before, 0) if x is not None) or None)
        if self.run_due and clock.tick is not None:
            self._run(clock)
        self._compact(clock)
        self.forget_expired(batch_id)

    def decide(self, events: DataFrame, batch_id: int, clock: Clock) -> DataFrame:
        """Route a batch and admit it against the ledger of earlier batches."""
        at = F.coalesce(F.try_to_timestamp("time_created"), F.timestamp_micros(F.lit(clock.arrived)))
        routed = route_events(events.withColumn("at", at), self.rules, self.manifest)
        windows = self.rules.select(
            F.col("name").alias("job"),
            *(iso_duration_micros(F.col(name)).alias(name) for name in WINDOW_COLUMNS),
        )
        full = task_key_full(F.col("bucket"), F.col("name"))
        digest = content_hash(
            F.col("mode"), F.col("bucket"), F.col("name"), F.col("name"), F.col("generation"),
            F.col("md5_hash"), F.col("crc32c"), F.col("manual_hint"),
        )
        keyed = routed.join(windows, "job", "left").select(
            "job",
            "mode",
            "bucket",
            "name",
            "at",
            F.concat_ws("|", "job", full).alias("task_key"),
            event_uid(F.col("bucket"), F.col("name"), F.col("generation")).alias("event_uid"),
            digest.alias("content_hash"),
            F.when(is_manual(F.col("generation")), "manual").otherwise("eventarc").alias("source"),
            "force_run",
            *WINDOW_COLUMNS,
        )
        last = None
        if self._day_names("ledger"):
            # Older records are out of every look-back, and their days are not opened.
            horizon = keyed.agg(
                F.min(F.unix_micros("at") - window_or_default(F.col("cooldown_window"), DEFAULT_COOLDOWN)).alias("t")
            ).head().t
            last = self.look_back(horizon, batch_id) if horizon is not None else None
        return admit(
            keyed,
            F.col("task_key"),
            F.col("at"),
            order=["event_uid", "content_hash"],
            uid=F.col("event_uid"),
            content_hash=F.col("content_hash"),
            force=F.col("force_run"),
            windows=window_columns(*(F.col(name) for name in WINDOW_COLUMNS)),
            last=last,
        )

    def look_back(self, horizon: int, batch_id: int) -> DataFrame | None:
        """The last record of each key since ``horizon``, as batches before ``batch_id`` left it."""
        found = self._days("ledger", since=horizon, before=batch_id)
        if found is None:
            return None
        return latest_per_key(found.filter(F.unix_micros("created_at") >= horizon), tie=["event_uid"])

    def _run(self, clock: Clock) -> None:
        """Load what has become due since the clock of the batch before."""
        since = None if clock.before is None else clock.before - clock.delay
        # What this batch accepted may be older than that.
        parts = [self._days("ledger", since=since, before=clock.batch_id), self._days("ledger", batch=clock.batch_id)]
        parts = [p for p in parts if p is not None]
        if not parts:
            return
        ledger = reduce(DataFrame.unionByName, parts)
        due = due_tasks(ledger, F.timestamp_micros(F.lit(clock.tick)))
        if clock.before is not None:
            # Tasks of earlier batches that were due then have run then.
            due = due.filter((F.col("batch_id") == clock.batch_id) | (F.unix_micros("scheduled_at") > clock.before))
        self._run_all(due, clock.batch_id, since)

    def run_tasks(self, now: datetime) -> None:
        """Load every accepted task that is due at ``now`` and has not run, without a further event.

        The timer calls it; calling it again with the same time changes nothing.
        """
        ledger = self._days("ledger")
        if ledger is not None:
            number = (now - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
            self._run_all(due_tasks(ledger, F.timestamp_micros(F.lit(number))), number, None)

    def _run_all(self, due: DataFrame, batch_id: int, since: int | None) -> None:
        # A record may stand in a batch and in its compacted day.
        due = due.drop("batch_id").dropDuplicates(["task_id"])
        for name in ("runs", "refused"):
            done = self._days(name, since=since)
            if done is not None:
                # A replay runs its own tasks again, those of other batches not.
                others = done.filter(F.col("batch_id") != batch_id).select("task_id").distinct()
                due = due.join(others, "task_id", "left_anti")
        due = due.filter(F.col("job").isin(list(self.loads)))
        if due.isEmpty():
            return
        checked = self._checked(due, batch_id)
        refused = checked.filter("error IS NOT NULL").select(*REFUSED_COLUMNS)
        self._write_days(refused, "refused", batch_id)
        ready = checked.filter("error IS NULL").withColumn("path", F.col("input_path"))
        # One row per job and path, the reader needs them here; jobs are few.
        for job in sorted(row.job for row in ready.select("job").distinct().collect()):
            self._load(self.loads[job], ready.filter(F.col("job") == job), batch_id)
        self._write_days(ready.select("task_id", "job", "bucket", "path", "args", "created_at"), "runs", batch_id)

    def _checked(self, due: DataFrame, batch_id: int) -> DataFrame:
        """The run step as a table: what each task loads, with rendered arguments, or why not.

        Paths are checked against the listing, if there is one.
        """
        if self.manifest is not None:
            resolved = resolve_input_path(due, self.manifest)
        else:
            path = F.when(F.col("mode") == "marker", strip_filename(F.col("name"))).otherwise(F.col("name"))
            resolved = due.withColumn("error", F.lit(None).cast("string")).withColumn("input_path", path)
        known = {"source_bucket": F.col("bucket"), "source_prefix": F.coalesce("input_path", F.col("name")), "run_uuid": F.col("task_id")}
        if "args" in self.rules.columns:
            own = self.rules.select(F.col("name").alias("job"), F.col("args").alias("_args"))
            resolved = resolved.join(own, "job", "left")
        else:
            resolved = resolved.withColumn("_args", F.array().cast("array<string>"))
        args = render_args(F.coalesce("_args", F.array().cast("array<string>")), known)
        return resolved.withColumn("args", set_arg(args, F.col("task_id"))).drop("_args")

    def _load(self, spec: LoadSpec, due: DataFrame, batch_id: int) -> None:
        newest = due.groupBy("bucket", "path").agg(F.max("scheduled_at").alias("t")).orderBy("t", "bucket", "path")
        paths = [self.locate(row.bucket, row.path) for row in newest.collect()]
        run = f"{spec.job}-{batch_id}"
        if spec.mode == "partition_range":
            # All folders in one scan and one write.
            run_load(self.spark, spec, paths, run)
        elif spec.mode == "partition":
            for number, path in enumerate(paths):
                run_load(self.spark, spec, path, f"{run}-{number}")
        else:
            # Each replaces the table in turn: all are checked and audited, the newest stays.
            for number, path in enumerate(paths):
                run_load(self.spark, spec, path, run if len(paths) == 1 else f"{run}-{number}")

    def decisions(self) -> DataFrame | None:
        return self._days("decisions")

    def late(self) -> DataFrame | None:
        found = self._days("decisions")
        return None if found is None else found.filter(F.col("status") == LATE)

    def _begin(self, batch_id: int) -> Clock:
        """The clock as the batch before left it; a batch run again gets its own arrival time back."""
        before, own = self._clock_row(batch_id - 1), self._clock_row(batch_id)
        arrived = own.arrived if own else int(datetime.now(timezone.utc).timestamp() * 1_000_000)
        windows = self.rules.select(*(iso_duration_micros(F.col(name)).alias(name) for name in WINDOW_COLUMNS))
        of = dict(zip(WINDOW_COLUMNS, (DEFAULT_DOUBLE_TAP, DEFAULT_COOLDOWN, DEFAULT_TTL, DEFAULT_DELAY)))
        tap, cooldown, ttl, delay = (window_or_default(F.col(name), of[name]) for name in WINDOW_COLUMNS)
        longest = windows.agg(
            F.max(F.greatest(tap + cooldown, delay) + ttl).alias("life"), F.max(delay).alias("delay")
        ).head()
        # Rules may have had longer windows before.
        life, delay = (max(x or 0, getattr(before, n) if before else 0) for n, x in longest.asDict().items())
        clock = Clock(batch_id, arrived, before.tick if before else None, own.tick if own else None, life, delay)
        self._write(self.spark.createDataFrame([clock], CLOCK).drop("batch_id"), "clock", batch_id)
        return clock

    def _tick(self, clock: Clock, tick: int | None) -> Clock:
        clock = clock._replace(tick=tick)
        self._write(self.spark.createDataFrame([clock], CLOCK).drop("batch_id"), "clock", clock.batch_id)
        # A replay needs the row before its own, nothing needs older ones.
        Folder(self.spark, f"{self.state}/clock").remove(f"batch_id={clock.batch_id - 2}")
        return clock

    def _clock_row(self, batch_id: int) -> Clock | None:
        path = f"{self.state}/clock/batch_id={batch_id}"
        if not Folder(self.spark, path).holds_files():
            return None
        row = self.spark.read.schema(CLOCK).parquet(path).head()
        return Clock(batch_id, *row[1:]) if row else None

    def _compact(self, clock: Clock) -> None:
        """Turn the batches of closed days into one each: last records, and what is still to run."""
        today = day_name(clock.tick) if clock.tick is not None else ""
        for day in self._day_names("ledger"):
            folder = Folder(self.spark, f"{self.state}/ledger/{DAY}={day}")
            batches = [int(x.split("=")[1]) for x in folder.children() if x.startswith("batch_id=")]
            # The batch at hand may be run again. Compacted ones have numbers below zero.
            old, whole = [b for b in batches if b < clock.batch_id], -1 - clock.batch_id
            if day >= today or len(old) < 2:
                continue
            if whole not in batches:
                rows = self._days("ledger", day=day, before=clock.batch_id).drop(DAY, "batch_id").dropDuplicates(["task_id"])
                waiting = rows.filter(F.unix_micros("scheduled_at") > clock.tick) if self.run_due else rows
                keep = latest_per_key(rows, tie=["event_uid"]).unionByName(waiting).dropDuplicates(["task_id"])
                self._write_days(keep, "compacted", clock.batch_id)
                made = Folder(self.spark, f"{self.state}/compacted/{DAY}={day}")
                made.move(f"batch_id={clock.batch_id}", f"{self.state}/ledger/{DAY}={day}/batch_id={whole}")
            # A failure up to here leaves records twice, which readers of the ledger allow for.
            for batch in old:
                if batch != whole:
                    folder.remove(f"batch_id={batch}")

    def forget_expired(self, batch_id: int) -> list[str]:
        """Remove the days of which every task has expired by the clock; nothing has to be read."""
        clock = self._clock_row(batch_id)
        if clock is None or clock.tick is None:
            return []
        # A task of a day's last moment has lived its longest life.
        gone = {
            day
            for name in ("ledger", "decisions", "runs", "refused")
            for day in self._day_names(name)
            if day != NO_DAY and day_end(day) + clock.life < clock.tick
        }
        if gone and not self.run_due:
            gone -= self._waiting(gone)
        for name in ("ledger", "decisions", "runs", "refused"):
            folder = Folder(self.spark, f"{self.state}/{name}")
            for day in gone.intersection(self._day_names(name)):
                folder.remove(f"{DAY}={day}")
        return sorted(gone)

    def _waiting(self, days: set[str]) -> set[str]:
        """Days with tasks that the timer has not come to yet."""
        ledger = self._days("ledger")
        if ledger is None:
            return set()
        left = ledger.filter(F.col(DAY).isin(sorted(days)) & F.col("job").isin(list(self.loads)))
        for name in ("runs", "refused"):
            done = self._days(name)
            if done is not None:
                left = left.join(done.select("task_id").distinct(), "task_id", "left_anti")
        return {r[DAY] for r in left.select(DAY).distinct().collect()}

    def _day_names(self, name: str) -> list[str]:
        prefix = f"{DAY}="
        return sorted(x[len(prefix) :] for x in Folder(self.spark, f"{self.state}/{name}").children() if x.startswith(prefix))

    def _days(
        self, name: str, since: int | None = None, before: int | None = None, batch: int | None = None, day: str | None = None
    ) -> DataFrame | None:
        """The rows of a table of days; only the days from ``since`` on are listed and opened."""
        root = f"{self.state}/{name}"
        days = [d for d in self._day_names(name) if (since is None or d >= day_name(since)) and day in (None, d)]
        paths = [f"{root}/{DAY}={d}" for d in days]
        if batch is not None:
            paths = [p for d in paths if Folder(self.spark, p := f"{d}/batch_id={batch}").holds_files()]
        if not paths:
            return None
        schema = SCHEMAS.get(name) or self._schema(name)
        found = self.spark.read.schema(f"{schema}, {DAY} string, batch_id bigint").option("basePath", root).parquet(*paths)
        return found if before is None else found.filter(F.col("batch_id") < before)

    def _schema(self, name: str) -> str:
        extra = ", status string" if name == "decisions" else ", task_id string"
        return SCHEMAS["task"] + extra

    def _write_days(self, df: DataFrame, name: str, batch_id: int) -> None:
        """Rows by the day of their task and the batch."""
        day = F.coalesce(F.date_format("created_at", "yyyy-MM-dd"), F.lit(NO_DAY))
        (
            df.withColumns({DAY: day, "batch_id": F.lit(batch_id)})
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY, "batch_id")
            .parquet(f"{self.state}/{name}")
        )

    def _write(self, df: DataFrame, name: str, batch_id: int) -> None:
        (
            df.withColumn("batch_id", F.lit(batch_id))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("batch_id")
            .parquet(f"{self.state}/{name}")
        )

