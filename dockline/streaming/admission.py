"""Admission on a stream with one small task per key as state.

Same decisions as the batch operator. Within a micro-batch a key's events are
sorted by time; an event older than the last accepted one of its key is ``late``.
Keys are dealt by their hash to ``GROUPS`` groups, whose tasks are one state: a call
into Python costs some milliseconds, so one for every key and micro-batch would
cost far more than the decisions. A group's events are decided at once by the batch
fold, with its tasks as seeds, and its state is written anew when it is touched.
Most of what is left is the way of the rows through Arrow and pandas, so a row takes
along only what the decisions and the answer need.
A key is forgotten once the watermark passes the expiry of its last task, which
is later than any look-back. An event behind the watermark whose key is not known
(any more) is ``late`` as well, without task times: what was accepted around it
cannot be told. Every event gets an answer; those without a time are ``undated``.

Spark drops rows behind the watermark of the column that carries it before they
reach the state. Events therefore carry their arrival time, which is behind no
watermark, and a branch of the stream that yields no rows (the clock) follows the
event times. The query's watermark is the lesser of both, that is the clock's; this
is Spark's default policy for several watermarks (``multipleWatermarkPolicy=min``).

A micro-batch's events of one group meet in one task, so bound the batch
(``maxFilesPerTrigger``). Where a single key floods the stream, use the batch
operator in ``foreachBatch`` instead, as ``continuous`` does.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..constants import LATE, UNDATED
from ..operators.admission import Task, Windows, answered, output_schema, prepare, task_times

# Groups of keys; the layout of a stream's state, so not to be changed under a checkpoint.
GROUPS = 1024

# JSON: the last task of each key, and when it is forgotten.
_STATE = "tasks string"
_NEVER = -(2**63)
_TIMES = ("_created", "_scheduled", "_cooldown_until", "_expire_at")
_WINDOWS = ("_double_tap", "_cooldown", "_ttl", "_delay")
# Columns whose missing values are marked in one number.
_BITS = 60


def _clocked(stream: DataFrame, events: DataFrame, at: str, watermark: str) -> DataFrame:
    """The stream with a watermark that follows ``at`` but is behind none of its rows."""
    rows = stream.withColumn("_clock", F.current_timestamp()).withWatermark("_clock", "0 seconds")
    clock = events.select(
        *(F.lit(None).cast(f.dataType).alias(f.name) for f in stream.schema.fields),
        F.col(at).cast("timestamp").alias("_clock"),
    ).withWatermark("_clock", watermark)
    # No event lies that far back; a plain ``false`` would remove the branch from the plan.
    return rows.union(clock.filter(F.unix_micros("_clock") == F.lit(_NEVER)))


def admit_stateful(
    events: DataFrame,
    key: Column,
    at: str,
    *,
    watermark: str = "1 hour",
    order: Iterable[str] = (),
    uid: Column | None = None,
    content_hash: Column | None = None,
    force: Column | None = None,
    windows: Windows | dict[str, Column] | None = None,
) -> DataFrame:
    """Append ``status`` and task times to a stream; ``at`` is its timestamp column.

    The stream must not have a watermark of its own yet.
    """
    order, names = list(order), events.columns
    kinds = {f.name: f.dataType for f in events.schema.fields}
    # pandas would turn nullable longs into floats and holds few centuries: longs and times travel as
    # longs without missing values, the event time once, and what is missing as bits of another column.
    exact = [name for name in names if isinstance(kinds[name], (T.LongType, T.TimestampType))]
    moments = [name for name in exact if isinstance(kinds[name], T.TimestampType)]
    marked = [name for name in exact if name != at]
    marks = {
        f"_missing{i}": reduce(add, (F.shiftleft(F.col(n).isNull().cast("bigint"), j) for j, n in enumerate(marked[i : i + _BITS])))
        for i in range(0, len(marked), _BITS)
    }
    ties = {f"_tie{i}": F.col(name) for i, name in enumerate(order) if name not in exact}
    # What is the same for all events is not sent along with each of them.
    own_windows = _WINDOWS if isinstance(windows, dict) else ()
    facts = {"_uid": uid, "_digest": content_hash, "_force": force}
    inputs = ["_key", "_at", *(name for name, column in facts.items() if column is not None), *own_windows]
    stream = prepare(events, key, F.col(at), uid, content_hash, force, windows).withColumns(marks | ties)
    # No value is missing, so that pandas keeps the column whole.
    stream = stream.withColumns(
        {"_at": F.coalesce("_at", F.lit(_NEVER))} | {n: F.coalesce(n, F.lit(0).cast("bigint")) for n in own_windows}
    )
    numbers = {n: F.coalesce(F.unix_micros(n) if n in moments else F.col(n), F.lit(0).cast("bigint")) for n in marked}
    sent = [name for name in names if name not in exact or name in marked]
    columns = [*sent, *inputs, *marks, *ties]
    stream = stream.withColumns(numbers).select(*columns)
    limits = {} if own_windows else (windows or Windows()).micros()
    texts = T.StructType([T.StructField(f.name, T.LongType() if f.name in exact else f.dataType, True) for f in events.schema.fields])
    stream = _clocked(stream, events, at, watermark)

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        tasks = {k: (Task(*task), until) for k, (task, until) in json.loads(state.get[0]).items()} if state.exists else {}
        clock = state.getCurrentWatermarkMs()
        seen: set[str] = set()
        given = None
        if not state.hasTimedOut:
            frames = list(frames)
            rows = {name: np.concatenate([frame[name].to_numpy() for frame in frames]) for name in columns}
            missing = {n: rows[f"_missing{i - i % _BITS}"] >> i % _BITS & 1 == 1 for i, n in enumerate(marked)}
            if at in exact:
                rows[at], missing[at] = rows["_at"], rows["_at"] == _NEVER
            codes, keys = pd.factorize(rows["_key"])
            sort = [codes, rows["_at"]]
            for i, name in enumerate(order):
                # Missing values come last.
                sort += [missing[name], rows[name]] if name in exact else [_ranks(rows[f"_tie{i}"])]
            place = np.lexsort(sort[::-1])
            rows = {name: values[place] for name, values in rows.items()}
            status, times, unknown = _settled(codes[place], keys, rows, limits, tasks, clock)
            seen.update(keys)
            # With a mask of their own, as missing values would turn the others into floats.
            given = pd.DataFrame(
                {n: pd.arrays.IntegerArray(rows[n], missing[n][place]) if n in exact else rows[n] for n in names}
                | {"status": status}
                | {name: pd.arrays.IntegerArray(values, unknown) for name, values in zip(_TIMES, times)}
            )
        # Keys without events in this micro-batch are forgotten behind the watermark, as Spark does with states.
        tasks = {
            k: (task, max(task.expire // 1000, clock + 1) if k in seen else until)
            for k, (task, until) in tasks.items()
            if k in seen or until >= clock
        }
        if tasks:
            state.update((json.dumps(tasks),))
            state.setTimeoutTimestamp(max(min(until for _, until in tasks.values()), clock + 1))
        elif state.exists:
            state.remove()
        if given is not None:
            yield given

    stream = stream.withColumn("_group", F.pmod(F.xxhash64("_key"), F.lit(GROUPS)))
    folded = stream.groupBy("_group").applyInPandasWithState(
        step, output_schema(texts), _STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    return task_times(folded.withColumns({name: F.timestamp_micros(name) for name in moments}), names)


def _ranks(values: np.ndarray) -> np.ndarray:
    """Places of the values in their order, missing ones last."""
    codes = pd.Categorical(values, ordered=True).codes
    return np.where(codes < 0, len(values), codes)


def _settled(
    codes: np.ndarray, keys: np.ndarray, rows: dict[str, np.ndarray], limits: dict[str, int], tasks: dict, clock: int
) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """Statuses, task times and the rows without, of events sorted by key (as a number) and time.

    All are decided at once by the batch fold, which gets the tasks of the keys as
    seeds; ``tasks`` then holds what was accepted last.
    """
    at, n = rows["_at"], len(codes)
    known = np.array([k in tasks for k in keys])[codes]
    dated = at != _NEVER
    decided = dated & (known | (at >= clock * 1000))
    status = np.where(dated, LATE, UNDATED).astype(object)
    times = [np.zeros(n, np.int64) for _ in _TIMES]
    if not decided.any():
        return status, times, ~decided
    own = codes[decided]
    held = np.unique(own[known[decided]])
    seeds = [tasks[keys[code]][0] for code in held.tolist()]
    # A seed comes before the events of its key.
    place = np.argsort(np.concatenate([held, own]), kind="stable")

    def column(of_seeds: list, of_events, dtype=np.int64) -> np.ndarray:
        events = of_events[decided] if isinstance(of_events, np.ndarray) else np.full(len(own), of_events, dtype)
        return np.concatenate([np.array(of_seeds, dtype), events.astype(dtype, copy=False)])[place]

    blank = [0] * len(seeds)
    uid = column([task.uid for task in seeds], rows.get("_uid"), object)
    digest = column([task.digest for task in seeds], rows.get("_digest"), object)
    columns = {
        "_key": np.concatenate([held, own])[place],
        "_seed": column([True] * len(seeds), False, bool),
        "_at": column([task.created for task in seeds], at),
        "_force": column([False] * len(seeds), rows.get("_force", False), bool),
        **{name: column(blank, rows[name] if name in rows else limits[name]) for name in _WINDOWS},
        "_sched": column([task.scheduled for task in seeds], 0),
        "_until": column([task.until for task in seeds], 0),
        "_expire": column([task.expire for task in seeds], 0),
    }
    words = {"_uid": pa.array(uid, pa.string(), from_pandas=True), "_digest": pa.array(digest, pa.string(), from_pandas=True)}
    fold, answers, holder = answered({name: pa.array(values) for name, values in columns.items()} | words)
    events = ~fold.seed
    status[decided] = answers[events]
    found = (fold.at, fold.sched, fold.until, fold.expire)
    for values, all_found in zip(times, found):
        values[decided] = all_found[holder][events]
    last = holder[np.unique(fold.end - 1)]
    for row in last[events[last]].tolist():
        task = Task(*(int(values[row]) for values in found), uid[row], digest[row])
        tasks[keys[columns["_key"][row]]] = task, 0
    return status, times, ~decided


def late_events(decisions: DataFrame) -> DataFrame:
    """Events that came after a later one of their key had been accepted."""
    return decisions.filter(F.col("status") == LATE)
