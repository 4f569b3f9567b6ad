"""Chains of accepted events over many slices, by pointer doubling.

A slice maps the state it is entered with to the state it is left with. Both are events: the
last one accepted. So the maps of all slices together are pointers between events, from an
event that a slice can be left with to the one that the chain leaves a later slice with:

1. Per slice and key, what a search from outside must know: its times, and for each reason to
   accept an event the first event that has it, and the first with another value.
2. Per event that a slice can end with, the moments from which each reason holds. A reason
   holds in a later slice at once if the slice begins after the moment; the slice that the
   moment falls into is asked.
3. Answers, the earliest of which is the next accepted event, and the event with which the
   slice it lies in is left.
4. The pointers are squared and the events reached from each key's start are marked, until
   ``2^rounds`` slices are passed.

All steps are grouped by slice or joined by event, and the number of steps grows with the
logarithm of the number of slices. The driver holds a few facts and one event per slice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch
from ..sinks.storage import drop_folder
from .fold import Rows

# Reasons to accept: any event, a forced one, a new uid, a new digest.
REASONS = ("any", "forced", "uid", "digest")
# monotonically_increasing_id keeps the partition, which is the slice, in its upper bits.
SLICE_SHIFT = 33
NEVER = (1 << 63) - 1

TASK = "created bigint, scheduled bigint, until bigint, expire bigint, uid string, digest string"
_FACTS = "slice int, key string, low bigint, high bigint, double_tap bigint, cooldown bigint, uniform boolean" + "".join(
    f", {r}_row bigint, {r}_value string, {r}_other bigint" for r in REASONS
)
_PROBE = pa.struct([("slice", pa.int32()), ("reason", pa.int32()), ("moment", pa.int64()), ("own", pa.string())])
_ENDS = f"row bigint, key string, {TASK}, first boolean, best bigint, probes array<struct<slice: int, reason: int, moment: bigint, own: string>>"
_ENDS_ARROW = pa.schema(
    [("row", pa.int64()), ("key", pa.string()), *((n, pa.int64()) for n in ("created", "scheduled", "until", "expire"))]
    + [("uid", pa.string()), ("digest", pa.string()), ("first", pa.bool_()), ("best", pa.int64()), ("probes", pa.list_(_PROBE))]
)

Columns = Callable[[pa.Table], dict[str, pa.Array]]


class Unit:
    """The events of one key in one slice, in order."""

    def __init__(self, table: pa.Table, columns: Columns) -> None:
        table = table.sort_by("_row").combine_chunks()
        self.columns = columns(table)
        self.rows = Rows(self.columns)
        self.ids = table.column("_row").to_numpy()
        self.events = ~self.rows.seed
        self.uid, self.digest = (_texts(self.columns[name]) for name in ("_uid", "_digest"))

    def members(self, reason: int) -> tuple[np.ndarray, np.ndarray]:
        """The events that a reason can accept, and the values that tell them from the last task."""
        rows = self.rows
        member = (
            self.events,
            self.events & rows.force,
            self.events & (rows.uid > 0),
            self.events & (rows.uid == 0) & (rows.digest > 0),
        )[reason]
        at = np.flatnonzero(member)
        return at, (self.digest if REASONS[reason] == "digest" else self.uid)[at]

    def ends(self) -> np.ndarray:
        """Per event, the place of the one accepted last in the slice if this one was accepted."""
        return self.rows.ends(self.rows.successors())


def _texts(column: pa.Array) -> np.ndarray:
    return np.array([x or "" for x in column.to_pylist()], object)


@dataclass
class Chain:
    """The slices of one key in order, with what is known of them."""

    slices: list[int] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    high: list[int] = field(default_factory=list)
    # For each reason, per slice: first member, its value, first member with another value.
    firsts: list[list[tuple[int, str, int]]] = field(default_factory=list)
    windows: set[tuple[int, int]] = field(default_factory=set)
    uniform: bool = True

    def settle(self) -> None:
        """From the firsts of single slices to those of a slice and all behind it."""
        self.firsts = [[*reason, (NEVER, "", NEVER)] for reason in map(list, zip(*self.firsts))]
        for reason in self.firsts:
            for i in range(len(reason) - 2, -1, -1):
                row, value, other = reason[i]
                behind, its_value, its_other = reason[i + 1]
                if row == NEVER:
                    reason[i] = reason[i + 1]
                elif other == NEVER:
                    reason[i] = (row, value, behind if its_value != value else its_other)


def chains_of(facts: list) -> dict[str, Chain]:
    """Per key that keeps its windows, its chain of slices."""
    out: dict[str, Chain] = {}
    for f in sorted(facts, key=lambda f: f.slice):
        chain = out.setdefault(f.key, Chain())
        chain.slices.append(f.slice)
        # A slice of nothing but the ledger's record has no times of its own; it is the first.
        chain.low.append(-NEVER if f.low is None else f.low)
        chain.high.append(-NEVER if f.high is None else f.high)
        if f.low is not None:
            chain.windows.add((f.double_tap, f.cooldown))
            chain.uniform &= f.uniform
        chain.firsts.append([(f[f"{r}_row"], f[f"{r}_value"], f[f"{r}_other"]) for r in REASONS])
    out = {key: chain for key, chain in out.items() if chain.uniform and len(chain.windows) == 1}
    for chain in out.values():
        chain.settle()
    return out


def _facts(rows: DataFrame, columns: Columns) -> DataFrame:
    def learn(table: pa.Table) -> pa.Table:
        unit = Unit(table, columns)
        rows, at = unit.rows, unit.rows.at[unit.events]
        out: dict = {"slice": int(table["_slice"][0].as_py()), "key": table["_key"][0].as_py(), "uniform": rows.uniform()}
        out |= {"low": int(at[0]), "high": int(at[-1])} if len(at) else {"low": None, "high": None}
        out |= {"double_tap": int(rows.dt[-1]), "cooldown": int(rows.cd[-1])}
        for number, reason in enumerate(REASONS):
            place, value = unit.members(number)
            other = np.flatnonzero(value != value[0]) if len(place) else []
            out[f"{reason}_row"] = int(unit.ids[place[0]]) if len(place) else NEVER
            out[f"{reason}_value"] = value[0] if len(place) else ""
            out[f"{reason}_other"] = int(unit.ids[place[other[0]]]) if len(other) else NEVER
        names = [c.split()[0] for c in _FACTS.split(", ")]
        return pa.Table.from_pylist([{n: out[n] for n in names}], _arrow(_FACTS))

    return rows.groupBy("_slice", "_key").applyInArrow(learn, _FACTS)


def _arrow(schema: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])


def _ends(rows: DataFrame, columns: Columns, chains: dict[str, Chain]) -> DataFrame:
    """The events that slices can be left with, what comes next at the latest, and what is to be asked."""

    def find(table: pa.Table) -> pa.Table:
        key, number = table["_key"][0].as_py(), int(table["_slice"][0].as_py())
        if key not in chains:
            return _ENDS_ARROW.empty_table()
        chain, unit = chains[key], Unit(table, columns)
        own = chain.slices.index(number)
        ends = unit.ends()
        ends = ends[:1] if own == 0 else np.unique(ends[: unit.rows.possible_starts()])
        rows, ((double_tap, cooldown),) = unit.rows, chain.windows
        at, sched, until = rows.at[ends], rows.sched[ends], rows.until[ends]
        ready = np.maximum(at + double_tap, sched)
        uid, digest, nothing = unit.uid[ends], unit.digest[ends], np.full(len(ends), "", object)
        best = np.full(len(ends), NEVER, np.int64)
        probes: list[list[dict]] = [[] for _ in ends]
        for reason, moments, values in (
            (0, at + cooldown + 1, nothing),
            (0, np.maximum(ready, until), uid),
            (1, at + double_tap, uid),
            (2, ready, uid),
            (3, ready, digest),
        ):
            # The first slice behind this one that reaches the moment.
            target = own + 1 + np.searchsorted(np.array(chain.high[own + 1 :], np.int64), moments)
            for i, (t, moment, value) in enumerate(zip(target.tolist(), moments.tolist(), values)):
                if t < len(chain.slices):
                    inside = chain.low[t] < moment
                    row, its_value, other = chain.firsts[reason][t + inside]
                    best[i] = min(best[i], other if value and its_value == value else row)
                    if inside:
                        probes[i].append({"slice": chain.slices[t], "reason": reason, "moment": moment, "own": value})
        task = [rows.at, rows.sched, rows.until, rows.expire]
        texts = [unit.columns[name].take(pa.array(ends)) for name in ("_uid", "_digest")]
        arrays = [pa.array(unit.ids[ends]), pa.array([key] * len(ends)), *(pa.array(x[ends]) for x in task), *texts]
        arrays += [pa.array([own == 0] * len(ends)), pa.array(best), pa.array(probes, pa.list_(_PROBE))]
        return pa.table(arrays, _ENDS_ARROW)

    return rows.groupBy("_slice", "_key").applyInArrow(find, _ENDS)


def _answers(ends: DataFrame, rows: DataFrame, columns: Columns) -> DataFrame:
    """Per probe, the first event in its slice for which the reason holds."""
    asked = ends.select("row", "key", F.explode("probes").alias("p")).select("row", "key", "p.*")

    def answer(probes: pa.Table, table: pa.Table) -> pa.Table:
        found: list[tuple[int, int]] = []
        if probes.num_rows and table.num_rows:
            unit = Unit(table, columns)
            reasons = [unit.members(r) for r in range(len(REASONS))]
            for row, reason, moment, own in zip(*(probes[n].to_pylist() for n in ("row", "reason", "moment", "own"))):
                place, value = reasons[reason]
                first = int(np.searchsorted(unit.rows.at[place], moment))
                if own and first < len(place) and value[first] == own:
                    other = np.flatnonzero(value[first:] != own)
                    first = first + int(other[0]) if len(other) else len(place)
                if first < len(place):
                    found.append((row, int(unit.ids[place[first]])))
        columns_found = list(zip(*found)) or [[], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns_found], ["row", "best"])

    return asked.groupBy("slice", "key").cogroup(rows.groupBy("_slice", "_key")).applyInArrow(answer, "row bigint, best bigint")


def _left_with(following: DataFrame, rows: DataFrame, columns: Columns) -> DataFrame:
    """From ``(row, next)`` to ``(row, to)``: the event the slice of ``next`` is left with."""
    placed = following.select("row", "key", "next", F.shiftright("next", SLICE_SHIFT).cast("int").alias("slice"))

    def point(wanted: pa.Table, table: pa.Table) -> pa.Table:
        if not wanted.num_rows or not table.num_rows:
            return pa.table([pa.array([], pa.int64())] * 2, ["row", "to"])
        unit = Unit(table, columns)
        at = np.searchsorted(unit.ids, wanted["next"].to_numpy())
        return pa.table([wanted["row"].combine_chunks(), pa.array(unit.ids[unit.ends()[at]])], ["row", "to"])

    return placed.groupBy("slice", "key").cogroup(rows.groupBy("_slice", "_key")).applyInArrow(point, "row bigint, to bigint")


def composed(rows: DataFrame, columns: Columns) -> tuple[set[str], list, int]:
    """Keys whose chains were followed, the event each of their slices is left with, and the rounds it took.

    ``rows`` are the events of keys that cross slices, with ``_slice`` and ``_row``. An event is
    a row ``(row, key, created, scheduled, until, expire, uid, digest)``; a slice in which
    nothing is accepted has none.
    """
    spark = rows.sparkSession
    path = scratch(spark, "chains")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{path}/{name}")
        return spark.read.schema(df.schema).parquet(f"{path}/{name}")

    try:
        chains = chains_of(_facts(rows, columns).collect())
        if not chains:
            return set(), [], 0
        ends = kept(_ends(rows, columns, chains), "ends")
        sure = ends.where(F.col("best") < NEVER).select("row", "best")
        nexts = _answers(ends, rows, columns).unionByName(sure).groupBy("row").agg(F.min("best").alias("next"))
        following = ends.select("row", "key").join(nexts, "row")
        pointers = _left_with(following, rows, columns)
        marked = ends.select("row", F.col("first").alias("mark")).join(pointers, "row", "left")
        table = kept(marked.select("row", "to", "mark"), "round-0")
        longest = max(len(c.slices) for c in chains.values())
        rounds = max(longest - 1, 0).bit_length()
        for number in range(1, rounds + 1):
            reached = table.where("mark AND to IS NOT NULL").select(F.col("to").alias("row"), F.lit(True).alias("hit")).distinct()
            onward = table.select(F.col("row").alias("to"), F.col("to").alias("further"))
            stepped = table.join(onward, "to", "left").join(reached, "row", "left")
            table = kept(stepped.select("row", F.col("further").alias("to"), (F.col("mark") | F.coalesce("hit", F.lit(False))).alias("mark")), f"round-{number}")
        on_chain = ends.join(table.where("mark").select("row"), "row", "left_semi")
        return set(chains), on_chain.drop("first", "best", "probes").collect(), rounds
    finally:
        drop_folder(spark, path)
