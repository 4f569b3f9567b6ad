"""Admission: which triggers of a key start a task, and which are held back.

The outcome of an event depends on the last *accepted* event of its key, so a key
is a chain. A chain is not gathered in one task: events are range-partitioned by
(key, time), which cuts a hot key into as many slices as its size needs, and each
slice is folded in order, batch by batch, with one small state.

A slice that starts inside a key needs the state its predecessor ends with. Those
boundary states (one per slice) are found from the keys that cross a boundary:
slices longer than the look-back are mapped from entry to exit at once, a few
others are folded on demand, and where that is not enough the maps of all slices
are composed by pointer doubling (``chains``), in as many rounds as the number of
slices has bits.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from datetime import timedelta
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import (
    ACCEPTED,
    COOLDOWN,
    DEFAULT_COOLDOWN,
    DEFAULT_DELAY,
    DEFAULT_DOUBLE_TAP,
    DEFAULT_TTL,
    DOUBLE_TAP,
    DUPLICATE,
    LATE,
    PENDING,
    UNDATED,
)
from ..functions.durations import to_micros, window_or_default
from ..session import enable_checkpoints, scratch
from ..sinks.storage import drop_folder
from .chains import SLICE_SHIFT, composed
from .fold import Rows


class Task(NamedTuple):
    """The last accepted event of a key; times in microseconds."""

    created: int
    scheduled: int
    until: int
    expire: int
    uid: str | None
    digest: str | None


@dataclass(frozen=True)
class Windows:
    double_tap: timedelta = DEFAULT_DOUBLE_TAP
    cooldown: timedelta = DEFAULT_COOLDOWN
    ttl: timedelta = DEFAULT_TTL
    delay: timedelta = DEFAULT_DELAY

    def micros(self) -> dict[str, int]:
        """The windows as all events have them."""
        own = {"_double_tap": self.double_tap, "_cooldown": self.cooldown, "_ttl": self.ttl, "_delay": self.delay}
        usual = (DEFAULT_DOUBLE_TAP, DEFAULT_COOLDOWN, DEFAULT_TTL, DEFAULT_DELAY)
        return {name: to_micros(window) or to_micros(default) for (name, window), default in zip(own.items(), usual)}

    def columns(self) -> dict[str, Column]:
        return window_columns(
            *(F.lit(to_micros(w)).cast("bigint") for w in (self.double_tap, self.cooldown, self.ttl, self.delay))
        )


def window_columns(double_tap: Column, cooldown: Column, ttl: Column, delay: Column) -> dict[str, Column]:
    """Per-event windows in microseconds; each falls back to its default when zero."""
    return {
        "_double_tap": window_or_default(double_tap, DEFAULT_DOUBLE_TAP),
        "_cooldown": window_or_default(cooldown, DEFAULT_COOLDOWN),
        "_ttl": window_or_default(ttl, DEFAULT_TTL),
        "_delay": window_or_default(delay, DEFAULT_DELAY),
    }


def decide(last: Task | None, at: int, uid, digest, force, double_tap: int, cooldown: int) -> str:
    """The outcome of one event, given the last accepted one of its key."""
    if last is None or last.created < at - cooldown:
        # Nothing in the look-back window.
        return ACCEPTED
    if at < last.created:
        return LATE
    if uid and uid == last.uid:
        return DUPLICATE
    if at < last.created + double_tap:
        return DOUBLE_TAP
    if force:
        return ACCEPTED
    if at < last.scheduled:
        return PENDING
    changed = bool(uid) or (bool(digest) and digest != last.digest)
    return COOLDOWN if at < last.until and not changed else ACCEPTED


def accept(at: int, uid, digest, force, double_tap: int, cooldown: int, ttl: int, delay: int) -> Task:
    scheduled = at if force else at + delay
    until = max(at + double_tap + cooldown, scheduled)
    return Task(at, scheduled, until, until + ttl, uid, digest)


# Names of the prepared columns, in the order the fold reads them.
_INPUTS = ("_key", "_seed", "_at", "_uid", "_digest", "_force", "_double_tap", "_cooldown", "_ttl", "_delay", "_sched", "_until", "_expire")
_OUTPUTS = ("_created", "_scheduled", "_cooldown_until", "_expire_at")


def fold_batch(
    batch: pa.RecordBatch, key: str, state: Task | None
) -> tuple[pa.Array, list[pa.Array], str, Task | None]:
    """Answers for a sorted batch, given the last key before it and its state.

    Returns the statuses, the task times, and the same two for what follows.
    """
    columns = {name: batch.column(name) for name in _INPUTS}
    carried = state is not None and columns["_key"][0].as_py() == key
    if carried:
        columns = _with_states(columns, key, [state])
    rows, status, holder = answered(columns)
    skip = int(carried)
    times = [pa.array(values[holder][skip:]) for values in (rows.at, rows.sched, rows.until, rows.expire)]
    state = _task(rows, columns, int(holder[-1]))
    return pa.array(status[skip:], pa.string()), times, columns["_key"][-1].as_py(), state


def answered(columns: dict[str, pa.Array]) -> tuple[Rows, np.ndarray, np.ndarray]:
    """Sorted rows, their statuses, and the rows whose tasks they answer with."""
    rows = Rows(columns)
    if rows.uniform():
        accepted = rows.accepted(rows.successors())
    else:
        accepted = _accepted_one_by_one(columns)
    return rows, *rows.answers(accepted)


def _accepted_one_by_one(columns: dict[str, pa.Array]) -> np.ndarray:
    """The accepted rows where the windows of a key differ between its events."""
    marks, current, state = [], None, None
    for k, seed, when, u, d, f, dt, cd, ttl, delay, sched, until, expire in zip(
        *(columns[name].to_pylist() for name in _INPUTS)
    ):
        if k != current:
            current, state = k, None
        if seed:
            state = Task(when, sched, until, expire, u, d)
        elif decide(state, when, u, d, f, dt, cd) == ACCEPTED:
            state = accept(when, u, d, f, dt, cd, ttl, delay)
        else:
            marks.append(False)
            continue
        marks.append(True)
    return np.array(marks, bool)


def prepare(
    events: DataFrame,
    key: Column,
    at: Column,
    uid: Column | None = None,
    content_hash: Column | None = None,
    force: Column | None = None,
    windows: Windows | dict[str, Column] | None = None,
) -> DataFrame:
    """Events with the columns the fold reads. ``at`` is a timestamp."""
    limits = windows if isinstance(windows, dict) else (windows or Windows()).columns()
    none_text, none_micros = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    return events.select(
        "*",
        F.coalesce(key.cast("string"), F.lit("")).alias("_key"),
        F.lit(False).alias("_seed"),
        F.unix_micros(at.cast("timestamp")).alias("_at"),
        (none_text if uid is None else uid.cast("string")).alias("_uid"),
        (none_text if content_hash is None else content_hash.cast("string")).alias("_digest"),
        (F.lit(False) if force is None else F.coalesce(force, F.lit(False))).alias("_force"),
        *(column.alias(name) for name, column in limits.items()),
        none_micros.alias("_sched"),
        none_micros.alias("_until"),
        none_micros.alias("_expire"),
    )


def _seeds(last: DataFrame) -> DataFrame:
    """Ledger records as rows that set a key's state before its events."""
    zero = F.lit(0).cast("bigint")
    return last.select(
        F.col("task_key").alias("_key"),
        F.lit(True).alias("_seed"),
        F.unix_micros("created_at").alias("_at"),
        F.col("event_uid").alias("_uid"),
        F.col("content_hash").alias("_digest"),
        F.lit(False).alias("_force"),
        *(zero.alias(name) for name in ("_double_tap", "_cooldown", "_ttl", "_delay")),
        F.unix_micros("scheduled_at").alias("_sched"),
        F.unix_micros("cooldown_until").alias("_until"),
        F.unix_micros("expire_at").alias("_expire"),
    )


def admit(
    events: DataFrame,
    key: Column,
    at: Column,
    *,
    order: Iterable[str] = (),
    uid: Column | None = None,
    content_hash: Column | None = None,
    force: Column | None = None,
    windows: Windows | dict[str, Column] | None = None,
    last: DataFrame | None = None,
    slices: int | None = None,
) -> DataFrame:
    """Every event with its ``status`` and the times of the task it answers with.

    ``order`` breaks ties of equal times. ``last`` holds the last ledger record of
    each key, if there is one. The task times are those of the new task for an
    accepted event, else those of the task that held it back. An event without a time is
    ``undated``: it is never accepted and holds nothing back.
    """
    columns = events.columns
    order = list(order)
    rows = prepare(events, key, at, uid, content_hash, force, windows)
    if last is not None:
        rows = rows.unionByName(_seeds(last), allowMissingColumns=True)
    # The hash splits even a long run of events that tie in everything else.
    tie = F.xxhash64(*order, "_uid", "_digest") if not order else F.xxhash64(*order)
    sort = ["_key", F.desc("_seed"), "_at", *order]
    spread = rows.withColumn("_tie", tie)
    ranged = spread.repartitionByRange(slices, *sort, "_tie") if slices else spread.repartitionByRange(*sort, "_tie")
    ordered = ranged.sortWithinPartitions(*sort, "_tie").withColumn("_slice", F.spark_partition_id())
    # The cut points must be the same in every pass below, and outlive executors.
    enable_checkpoints(events.sparkSession)
    ordered = ordered.checkpoint()
    entries = _boundary_states(ordered, seeded=last is not None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            undated = pc.is_null(batch.column("_at"))
            if pc.any(undated).as_py():
                # Without a time there is no place in the chain: set aside, nothing changes.
                aside = batch.filter(undated)
                nothing = [pa.nulls(aside.num_rows, pa.int64())] * len(_OUTPUTS)
                yield pa.RecordBatch.from_arrays(
                    [aside.column(name) for name in columns] + [pa.array([UNDATED] * aside.num_rows), *nothing],
                    names=[*columns, "status", *_OUTPUTS],
                )
                batch = batch.filter(pc.invert(undated))
            if batch.num_rows == 0:
                continue
            if key is None:
                key, state = batch.column("_key")[0].as_py(), entries.get(batch.column("_slice")[0].as_py())
            status, times, key, state = fold_batch(batch, key, state)
            yield pa.RecordBatch.from_arrays(
                [batch.column(name) for name in columns] + [status, *times], names=[*columns, "status", *_OUTPUTS]
            )

    folded = ordered.mapInArrow(run, output_schema(events.schema)).filter(F.col("status").isNotNull())
    return task_times(folded, columns)


def output_schema(events: T.StructType) -> T.StructType:
    fields = [T.StructField(f.name, f.dataType, True) for f in events.fields]
    fields.append(T.StructField("status", T.StringType()))
    return T.StructType(fields + [T.StructField(name, T.LongType()) for name in _OUTPUTS])


def task_times(folded: DataFrame, columns: list[str]) -> DataFrame:
    return folded.select(
        *columns,
        "status",
        F.timestamp_micros("_created").alias("created_at"),
        F.timestamp_micros("_scheduled").alias("scheduled_at"),
        F.timestamp_micros("_cooldown_until").alias("cooldown_until"),
        F.timestamp_micros("_expire_at").alias("expire_at"),
    )


class Slice(NamedTuple):
    """What is known of a slice that hands its last key on."""

    first: int
    last: int
    longest_cooldown: int
    least_cooldown: int
    least_tap: int
    forced: bool
    uids: bool
    low_digest: str | None
    high_digest: str | None

    def passes(self, state: Task) -> bool:
        """Certain to accept nothing after this state."""
        if self.last > state.created + self.least_cooldown:
            return False
        if self.last < state.created + self.least_tap:
            return True
        # Without a digest there is nothing to differ; equal ends mean one digest.
        quiet = not self.uids and {self.low_digest, self.high_digest} <= {None, state.digest}
        return not self.forced and (self.last < state.scheduled or (quiet and self.last < state.until))


def _boundary_states(ordered: DataFrame, seeded: bool) -> dict[int, Task]:
    """State in which each slice that starts inside a key must start.

    A slice that takes a key over and hands it on maps entry states to exit states.
    That map is worked out for all slices at once, for the states the slice before
    can possibly end with; what the map does not cover is folded on demand. Only
    facts per slice and a bounded number of states come to the driver.
    """
    bounds = (
        ordered.groupBy("_slice").agg(F.min("_key").alias("low"), F.max("_key").alias("high")).orderBy("_slice").collect()
    )
    crossings = [(p._slice, q._slice, p.high) for p, q in zip(bounds, bounds[1:]) if p.high == q.low]
    if not crossings:
        return {}
    taken_over = {right for _, right, _ in crossings}
    whole = {b._slice for b in bounds if b.low == b.high}
    handed_on = {left: key for left, _, key in crossings}
    through = taken_over & whole & handed_on.keys()

    # Only the keys that cross, and only what the fold reads, by slice: a round then
    # touches the slices it is about.
    spark = ordered.sparkSession
    path = scratch(spark, "boundary")
    keys = F.broadcast(spark.createDataFrame(list(handed_on.items()), "_slice int, _key string"))
    numbered = ordered.where("_at IS NOT NULL").select("_slice", *_INPUTS, F.monotonically_increasing_id().alias("_row"))
    numbered.join(keys, ["_slice", "_key"], "left_semi").write.partitionBy("_slice").parquet(path)
    try:
        return _settled(spark.read.parquet(path), crossings, through, seeded)
    finally:
        drop_folder(spark, path)


def _settled(
    rows: DataFrame, crossings: list[tuple[int, int, str]], through: set[int], seeded: bool
) -> dict[int, Task]:
    """The entry states, from the rows of crossing keys, by slice."""
    digest, event = F.nullif("_digest", F.lit("")), ~F.col("_seed")
    facts = rows.groupBy(F.col("_slice").cast("int").alias("_slice")).agg(
        F.min("_at").alias("first"),
        F.max("_at").alias("last"),
        F.max("_cooldown").alias("longest_cooldown"),
        F.coalesce(F.min(F.when(event, F.col("_cooldown"))), F.lit(0)).alias("least_cooldown"),
        F.coalesce(F.min(F.when(event, F.col("_double_tap"))), F.lit(0)).alias("least_tap"),
        F.bool_or("_force").alias("forced"),
        F.bool_or(F.coalesce("_uid", F.lit("")) != "").alias("uids"),
        F.min(digest).alias("low_digest"),
        F.max(digest).alias("high_digest"),
    )
    slices = {r._slice: Slice(*r[1:]) for r in facts.collect()}

    known: dict[tuple[int, Task | None], Task | None] = {}
    # Slices that start the key themselves, and those long enough to forget their entry.
    fresh = {s: [None] for s in slices if s not in through}
    long = {s for s in through if not seeded and slices[s].last - slices[s].first > slices[s].longest_cooldown}
    share = SPECULATIVE_STATES // max(len(long), 1)
    possible: dict[int, list[Task]] = {}
    for number, entry, state in _exits(rows, fresh, long, share):
        if entry is None:
            possible.setdefault(number, []).append(state)
        else:
            known[number, None] = state
            possible[number] = [state]
    ahead = {right: possible[left] for left, right, _ in crossings if right in long and possible.get(left)}
    for number, entry, state in _exits(rows, ahead, set(), 0):
        known[number, ahead[number][entry]] = state

    entries: dict[int, Task] = {}
    followed: set[str] | None = None
    lookups = 0
    while True:
        wanted: dict[int, list[Task]] = {}
        exits = {s: known[s, None] for s in fresh}
        for left, right, key in crossings:
            if key in (followed or ()):
                continue
            if left not in exits:
                # Behind a slice that is still to be folded.
                continue
            state = entries[right] = exits[left]
            if right not in through:
                continue
            if slices[right].passes(state):
                exits[right] = state
            elif (right, state) in known:
                exits[right] = known[right, state]
            else:
                wanted[right] = [state]
        if not wanted:
            return entries
        if followed is None and lookups == LOOKUPS:
            # Too dense for single steps: follow all chains at once.
            followed = _follow(rows, crossings, entries)
            continue
        lookups += 1
        for number, entry, state in _exits(rows, wanted, set(), 0):
            known[number, wanted[number][entry]] = state


def _follow(rows: DataFrame, crossings: list[tuple[int, int, str]], entries: dict[int, Task]) -> set[str]:
    """Settle the entries of all keys that keep their windows; the others are left to single steps."""
    keys, ends, _ = composed(rows, _input_columns)
    last: dict[str, dict[int, Task]] = {}
    for end in ends:
        last.setdefault(end.key, {})[end.row >> SLICE_SHIFT] = Task(*end[2:])
    for left, right, key in crossings:
        if key in keys:
            # A slice in which nothing is accepted is left as it was entered.
            entries[right] = last[key].get(left) or entries[left]
    return keys


# Rounds in which single slices are folded before all chains are followed.
LOOKUPS = 2
# Budget of exit states that may be tried ahead, over all slices.
SPECULATIVE_STATES = 200_000

_EXIT = T.StructType(
    [T.StructField("slice", T.IntegerType()), T.StructField("entry", T.IntegerType())]
    + [T.StructField(name, T.LongType()) for name in ("created", "scheduled", "until", "expire")]
    + [T.StructField("uid", T.StringType()), T.StructField("digest", T.StringType())]
)


def _exits(
    rows: DataFrame, entries: dict[int, list[Task | None]], unknown: set[int], share: int
) -> list[tuple[int, int | None, Task]]:
    """The states slices end with: ``(slice, number of the entry state, exit)``.

    For slices in ``unknown``, every state they can end with, whatever the entry,
    without a number; nothing if there are more than ``share``.
    """
    numbers = sorted(entries.keys() | unknown)
    if not numbers:
        return []

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("_row").combine_chunks()
        number = int(table.column("_slice")[0].as_py())
        # One slice of one key, cut to a bounded size by the range partitioning.
        columns = _input_columns(table)
        found = exits_of_any(columns, share) if number in unknown else exits_after(columns, entries[number])
        fields = list(zip(*((number, entry, *state) for entry, state in found))) or [[]] * len(_EXIT.fields)
        return pa.table([pa.array(list(v), t) for v, t in zip(fields, _EXIT_ARROW)], names=_EXIT.names)

    chosen = rows.filter(F.col("_slice").isin(numbers))
    return [(r.slice, r.entry, Task(*r[2:])) for r in chosen.groupBy("_slice").applyInArrow(run, _EXIT).collect()]


_EXIT_ARROW = [pa.int32(), pa.int32(), *([pa.int64()] * 4), pa.string(), pa.string()]
_ARROW = {name: pa.int64() for name in _INPUTS} | {
    "_key": pa.string(), "_uid": pa.string(), "_digest": pa.string(), "_seed": pa.bool_(), "_force": pa.bool_(),
}


def _input_columns(table: pa.Table) -> dict[str, pa.Array]:
    return {name: pc.cast(table.column(name), _ARROW[name]).combine_chunks() for name in _INPUTS}


def exits_of_any(columns: dict[str, pa.Array], share: int) -> list[tuple[None, Task]]:
    """Every state a slice of one key can end with."""
    rows = Rows(columns)
    if not rows.uniform():
        return []
    ends = np.unique(rows.ends(rows.successors())[: rows.possible_starts()])
    return [(None, _task(rows, columns, int(end))) for end in ends] if len(ends) <= share else []


def exits_after(columns: dict[str, pa.Array], entries: list[Task | None]) -> list[tuple[int, Task]]:
    """The state a slice of one key ends with, for each state it may start in."""
    given = [entry for entry in entries if entry is not None]
    started = _with_states(columns, columns["_key"][0].as_py(), given)
    rows = Rows(started)
    if rows.uniform():
        ends = rows.ends(rows.successors())
        # Entry states are the leading rows; without one, the first event starts.
        return [(i, _task(rows, started, int(ends[i]))) for i in range(len(entries))]
    found = []
    for number, entry in enumerate(entries):
        alone = _with_states(columns, columns["_key"][0].as_py(), [] if entry is None else [entry])
        accepted = np.flatnonzero(_accepted_one_by_one(alone))
        found.append((number, _task(Rows(alone), alone, int(accepted[-1]))))
    return found


def _with_states(columns: dict[str, pa.Array], key: str, states: list[Task]) -> dict[str, pa.Array]:
    """The columns of a sorted batch with states of its first key put in front."""
    if not states:
        return columns
    front = [
        dict(_key=key, _seed=True, _at=s.created, _uid=s.uid, _digest=s.digest, _force=False)
        | dict(_sched=s.scheduled, _until=s.until, _expire=s.expire)
        for s in states
    ]
    return {
        name: pa.concat_arrays([pa.array([row.get(name) for row in front], column.type), column])
        for name, column in columns.items()
    }


def _task(rows: Rows, columns: dict[str, pa.Array], row: int) -> Task:
    return Task(
        int(rows.at[row]),
        int(rows.sched[row]),
        int(rows.until[row]),
        int(rows.expire[row]),
        columns["_uid"][row].as_py(),
        columns["_digest"][row].as_py(),
    )
