"""Admission against a plain ledger walked through one event at a time."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from dockline.constants import DEFAULT_DELAY
from dockline.operators.admission import Windows, admit
from dockline.operators.ledger import latest_per_key
from dockline.streaming.admission import admit_stateful

BASE = datetime(2024, 1, 1, tzinfo=timezone.utc)
SCHEMA = "id bigint, key string, ts timestamp, uid string, digest string, force boolean"


def make_events(n, keys, span, seed, uids=True, hot=0.0):
    random.seed(seed)
    rows = []
    for i in range(n):
        key = "hot" if random.random() < hot else f"k{random.randrange(keys)}"
        uid = random.choice([None, "", f"u{random.randrange(max(n // 3, 1))}"]) if uids else None
        at = BASE + timedelta(seconds=random.randrange(span))
        rows.append((i, key, at, uid, random.choice(["a", "b", None]), random.random() < 0.1))
    return rows


def walk(rows, w, ledger=None):
    """What a service would answer that keeps every accepted task and looks them up."""
    ledger = [] if ledger is None else ledger
    answers = {}
    for i, key, now, uid, digest, force in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        seen = [t for t in ledger if t["key"] == key and t["created"] >= now - w.cooldown]
        last = max(seen, key=lambda t: t["created"]) if seen else None
        status = "accepted"
        if last is not None:
            differs = (uid and uid != last["uid"]) or (digest and digest != last["digest"])
            if now < last["created"]:
                status = "late"
            elif uid and uid == last["uid"]:
                status = "duplicate_event"
            elif now < last["created"] + w.double_tap:
                status = "double_tap"
            elif now < last["scheduled"] and not force:
                status = "pending"
            elif now < last["until"] and not (differs or force):
                status = "cooldown"
        if status == "accepted":
            # A zero delay stands for the default, as in a rule that names none.
            scheduled = now if force else now + (w.delay or DEFAULT_DELAY)
            until = max(now + w.double_tap + w.cooldown, scheduled)
            last = dict(key=key, created=now, scheduled=scheduled, until=until, expire=until + w.ttl, uid=uid, digest=digest)
            ledger.append(last)
        answers[i] = (status, last["created"], last["scheduled"], last["until"], last["expire"])
    return answers


def collected(df):
    names = ("created_at", "scheduled_at", "cooldown_until", "expire_at")
    micros = df.select("id", "status", *(F.unix_micros(n).alias(n) for n in names))
    return {
        r.id: (r.status, *(BASE + timedelta(microseconds=r[n] - int(BASE.timestamp()) * 10**6) for n in names))
        for r in micros.collect()
    }


def run(df, w, **more):
    return admit(
        df, F.col("key"), F.col("ts"), order=["id"], uid=F.col("uid"), content_hash=F.col("digest"),
        force=F.col("force"), windows=w, **more,
    )


CASES = [
    # Few gaps, many ties, every outcome.
    (Windows(timedelta(seconds=5), timedelta(seconds=60), timedelta(hours=1), timedelta(seconds=20)), True),
    (Windows(timedelta(seconds=1), timedelta(seconds=300), timedelta(hours=1), timedelta(seconds=0)), False),
    # The delay is longer than the look-back, the double tap longer than the cooldown.
    (Windows(timedelta(seconds=2), timedelta(seconds=10), timedelta(hours=1), timedelta(seconds=60)), True),
    (Windows(timedelta(seconds=90), timedelta(seconds=30), timedelta(hours=1), timedelta(seconds=5)), False),
]


@pytest.mark.parametrize("windows, uids", CASES)
@pytest.mark.parametrize("slices", [None, 13])
def test_batch_equals_the_walk(spark, windows, uids, slices):
    rows = make_events(1500, 6, 3000, seed=11, uids=uids, hot=0.5)
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(run(df, windows, slices=slices)) == walk(rows, windows)


@pytest.fixture
def small_batches(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "37")
    yield
    spark.conf.set(name, before)


@pytest.mark.parametrize("windows, uids", CASES)
def test_state_goes_from_batch_to_batch(spark, small_batches, windows, uids):
    rows = make_events(1500, 6, 3000, seed=13, uids=uids, hot=0.7)
    df = spark.createDataFrame(rows, SCHEMA)
    assert collected(run(df, windows, slices=5)) == walk(rows, windows)


def test_copies_of_one_event(spark, small_batches):
    """A third of all events repeat one uid."""
    w, _ = CASES[0]
    rows = make_events(900, 2, 1500, seed=19, uids=True)
    rows = [(i, k, t, "copy" if i % 3 == 0 else u, d, f) for i, k, t, u, d, f in rows]
    assert collected(run(spark.createDataFrame(rows, SCHEMA), w, slices=4)) == walk(rows, w)


def test_windows_that_change_within_a_key(spark, small_batches):
    """Each event brings its own windows; even ids are more patient."""
    patient, hasty = CASES[0][0], Windows(timedelta(seconds=2), timedelta(seconds=30), timedelta(hours=2), timedelta(seconds=9))
    rows = make_events(800, 3, 1500, seed=29, hot=0.4)
    even = F.col("id") % 2 == 0
    mixed = {n: F.when(even, a).otherwise(hasty.columns()[n]) for n, a in patient.columns().items()}
    found = collected(run(spark.createDataFrame(rows, SCHEMA), mixed, slices=3))
    ledger, expected = [], {}
    for row in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        expected |= walk([row], patient if row[0] % 2 == 0 else hasty, ledger)
    assert found == expected


def test_one_key_over_many_slices_without_gaps(spark):
    """Forced events never settle on their own; the boundary states must travel."""
    w = Windows(timedelta(seconds=7), timedelta(seconds=1000), timedelta(hours=1), timedelta(seconds=0))
    rows = [(i, "k", BASE + timedelta(seconds=i * 3), None, "a", True) for i in range(400)]
    df = spark.createDataFrame(rows, SCHEMA)
    found = collected(run(df, w, slices=10))
    assert found == walk(rows, w)
    assert {s for s, *_ in found.values()} == {"accepted", "double_tap"}


def test_every_outcome_occurs():
    windows, _ = CASES[0]
    rows = make_events(1500, 6, 3000, seed=11, hot=0.5)
    assert {s for s, *_ in walk(rows, windows).values()} == {
        "accepted", "duplicate_event", "double_tap", "pending", "cooldown",
    }


LONGER = Windows(timedelta(seconds=9), timedelta(seconds=400), timedelta(hours=1), timedelta(seconds=3))


@pytest.mark.parametrize("later", [CASES[0][0], LONGER])
@pytest.mark.parametrize("slices", [None, 9])
def test_ledger_carries_over(spark, slices, later):
    """The rule's windows may have been changed in between."""
    w, _ = CASES[0]
    rows = make_events(900, 4, 2000, seed=23, hot=0.4)
    # Some of the second half is older than what the first half accepted.
    first = [r for r in rows if r[2] < BASE + timedelta(seconds=1000)]
    second = [r for r in rows if r[2] >= BASE + timedelta(seconds=950)]
    ledger = []
    expected_first = walk(first, w, ledger)
    one = run(spark.createDataFrame(first, SCHEMA), w, slices=slices)
    assert collected(one) == expected_first
    records = one.filter("status = 'accepted'").select(
        F.col("key").alias("task_key"), F.col("uid").alias("event_uid"), F.col("digest").alias("content_hash"),
        "created_at", "scheduled_at", "cooldown_until", "expire_at",
    )
    two = run(spark.createDataFrame(second, SCHEMA), later, slices=slices, last=latest_per_key(records))
    assert collected(two) == walk(second, later, ledger)


def test_columns_pass_through(spark):
    rows = [(1, "k", BASE, None, None, False)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("payload", F.struct(F.lit(2**60 + 1).alias("big"), F.array(F.lit("x")).alias("a")))
    row = run(df, Windows()).head()
    assert (row.payload.big, row.payload.a, row.status) == (2**60 + 1, ["x"], "accepted")


def test_a_dense_key_skips_idle_slices(spark, monkeypatch):
    """Most slices lie within one delay: they are passed without folding them."""
    from dockline.operators import admission

    folded, original = [], admission._exits
    monkeypatch.setattr(admission, "_exits", lambda rows, entries, *more: folded.append(len(entries)) or original(rows, entries, *more))
    w = Windows(timedelta(seconds=5), timedelta(seconds=900), timedelta(hours=1), timedelta(seconds=400))
    rows = [(i, "k", BASE + timedelta(seconds=i), None, "a", False) for i in range(2000)]
    found = collected(run(spark.createDataFrame(rows, SCHEMA), w, slices=40))
    assert found == walk(rows, w)
    # Three tasks are accepted in 40 slices.
    assert sum(status == "accepted" for status, *_ in found.values()) == 3
    assert sum(folded) <= 8


def test_a_long_key_is_settled_in_two_rounds(spark, monkeypatch):
    """Slices longer than the look-back are mapped at once, not one after another."""
    from dockline.operators import admission

    rounds, original = [], admission._exits
    monkeypatch.setattr(admission, "_exits", lambda rows, entries, *more: rounds.append(len(entries)) or original(rows, entries, *more))
    w = Windows(timedelta(seconds=5), timedelta(seconds=60), timedelta(hours=1), timedelta(seconds=30))
    rows = [(i, "k", BASE + timedelta(seconds=i * 2), None, "ab"[i % 7 % 2], False) for i in range(3000)]
    found = collected(run(spark.createDataFrame(rows, SCHEMA), w, slices=12))
    assert found == walk(rows, w)
    assert len(rounds) == 2


def test_a_dense_key_is_followed_by_doubling(spark, monkeypatch):
    """64 slices, all shorter than the look-back, with a task accepted in nearly each."""
    from dockline.operators import admission

    rounds, original, steps = [], admission.composed, []
    monkeypatch.setattr(admission, "composed", lambda *a: rounds.append(original(*a)) or rounds[-1])
    exits = admission._exits
    monkeypatch.setattr(admission, "_exits", lambda *a: steps.append(1) or exits(*a))
    w = Windows(timedelta(seconds=5), timedelta(hours=3), timedelta(hours=1), timedelta(seconds=200))
    digests = [random.Random(i // 97).choice(["a", "b", None]) for i in range(20_000)]
    rows = [(i, "k", BASE + timedelta(seconds=i), None, digests[i], i % 1013 == 5) for i in range(20_000)]
    found = collected(run(spark.createDataFrame(rows, SCHEMA), w, slices=64))
    assert found == walk_one_key(rows, w)
    assert len(rounds) == 1 and rounds[0][2] <= 8 and len(steps) <= 4


def walk_one_key(rows, w):
    """The walk with the newest task only, for a key with many."""
    answers, ledger = {}, []
    for row in rows:
        answers |= walk([row], w, ledger)
        del ledger[:-1]
    return answers


@pytest.mark.parametrize("seed", range(4))
def test_doubling_equals_the_walk(spark, monkeypatch, seed):
    """Several dense keys with uids, digests, forced and tied events, and a ledger before them."""
    from dockline.operators import admission

    monkeypatch.setattr(admission, "LOOKUPS", 0)
    w = CASES[seed][0]
    w = Windows(w.double_tap, timedelta(seconds=500 + 100 * seed), w.ttl, w.delay)
    rows = make_events(700, 3, 900, seed=41 + seed, uids=seed % 2 == 0, hot=0.5)
    first, second = [r for r in rows if r[2] < BASE + timedelta(seconds=200)], [r for r in rows if r[2] >= BASE + timedelta(seconds=180)]
    ledger = []
    expected = walk(first, w, ledger)
    one = run(spark.createDataFrame(first, SCHEMA), w, slices=9)
    assert collected(one) == expected
    records = one.filter("status = 'accepted'").select(
        F.col("key").alias("task_key"), F.col("uid").alias("event_uid"), F.col("digest").alias("content_hash"),
        "created_at", "scheduled_at", "cooldown_until", "expire_at",
    )
    two = run(spark.createDataFrame(second, SCHEMA), w, slices=14, last=latest_per_key(records))
    assert collected(two) == walk(second, w, ledger)


@pytest.mark.parametrize("slices", [None, 7])
def test_events_without_a_time_are_set_aside(spark, slices):
    rows = make_events(300, 2, 600, seed=5, hot=0.6)
    bare = [(1000 + i, ("hot", "k0", None)[i % 3], None, None, "a", False) for i in range(60)]
    found = run(spark.createDataFrame([*rows, *bare], SCHEMA), CASES[0][0], slices=slices)
    assert collected(found.where("status <> 'undated'")) == walk(rows, CASES[0][0])
    aside = found.where("status = 'undated'")
    assert aside.count() == 60 and aside.where("created_at IS NOT NULL OR id < 1000").isEmpty()


def test_no_events(spark):
    assert run(spark.createDataFrame([], SCHEMA), Windows()).count() == 0


@pytest.mark.parametrize("batches", [1, 3, 10])
def test_stream_equals_batch(spark, folder, batches):
    w, _ = CASES[0]
    rows = sorted(make_events(600, 5, 1500, seed=31), key=lambda r: (r[2], r[0]))
    # Micro-batches are cut in time order, but rows of one file come in any order.
    size = -(-len(rows) // batches)
    for start in range(0, len(rows), size):
        part = rows[start : start + size]
        random.shuffle(part)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    admitted = admit_stateful(
        stream, F.col("key"), "ts", order=["id"], uid=F.col("uid"), content_hash=F.col("digest"), force=F.col("force"), windows=w
    )
    query = (
        admitted.writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert collected(spark.read.parquet(f"{folder}/out")) == walk(rows, w)


def test_stream_keys_share_states(spark, folder, monkeypatch):
    """Calls and states are bounded by the groups, not by the keys; answers are the batch's."""
    monkeypatch.setattr("dockline.streaming.admission.GROUPS", 4)
    w, _ = CASES[0]
    rows = sorted(make_events(600, 60, 1500, seed=32), key=lambda r: (r[2], r[0]))
    for start in range(0, len(rows), 250):
        spark.createDataFrame(rows[start : start + 250], SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    admitted = admit_stateful(
        stream, F.col("key"), "ts", order=["id"], uid=F.col("uid"), content_hash=F.col("digest"), force=F.col("force"), windows=w
    )
    query = (
        admitted.writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    states = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert 0 < max(states) <= 4
    assert collected(spark.read.parquet(f"{folder}/out")) == walk(rows, w)


def admitted_files(spark, folder, files):
    """The stream's answers, drained after each file with the default watermark."""
    for rows in files:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{folder}/in")
        admitted = admit_stateful(
            stream, F.col("key"), "ts", order=["id"], uid=F.col("uid"), content_hash=F.col("digest"), force=F.col("force"),
            windows=CASES[0][0],
        )
        admitted.writeStream.format("parquet").option("path", f"{folder}/out").option(
            "checkpointLocation", f"{folder}/checkpoint"
        ).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def test_stream_answers_events_behind_its_watermark(spark, folder):
    """Five events in three files, two of them a day late: of a known key, and of one that nothing is known of."""
    day = timedelta(days=1)
    files = [
        [(1, "a", BASE, "u1", "x", False)],
        [(2, "a", BASE + 3 * day, "u2", "x", False), (3, "b", BASE + 3 * day, "u3", "x", False)],
        [(4, "a", BASE + 2 * day, "u4", "x", False), (5, "c", BASE + 2 * day, "u5", "x", False)],
    ]
    out = {r.id: r for r in admitted_files(spark, folder, files).collect()}
    assert {i: r.status for i, r in out.items()} == {1: "accepted", 2: "accepted", 3: "accepted", 4: "late", 5: "late"}
    assert out[5].created_at is None and out[5].expire_at is None


def test_stream_sets_undated_events_aside(spark, folder):
    files = [
        [(1, "a", None, "u1", "x", False), (2, "a", BASE, "u2", "x", False)],
        [(3, "a", None, "u3", "x", False), (4, "b", None, None, None, None)],
    ]
    out = {r.id: r for r in admitted_files(spark, folder, files).collect()}
    assert {i: r.status for i, r in out.items()} == {1: "undated", 2: "accepted", 3: "undated", 4: "undated"}
    assert out[1].created_at is None and out[2].created_at is not None


def stateful(stream, windows, **more):
    return admit_stateful(
        stream, F.col("key"), "ts", order=["id"], uid=F.col("uid"), content_hash=F.col("digest"), force=F.col("force"),
        windows=windows, **more,
    )


def drained(admitted, folder):
    admitted.writeStream.format("parquet").option("path", f"{folder}/out").option(
        "checkpointLocation", f"{folder}/checkpoint"
    ).trigger(availableNow=True).start().awaitTermination()


def test_stream_sends_little_of_an_event_to_python(spark, folder):
    """Windows that all events share, and a second copy of longs and times, are not sent with each event."""
    stream = spark.readStream.schema(SCHEMA).parquet(folder)
    admitted = admit_stateful(stream, F.col("key"), "ts", order=["id"], content_hash=F.col("digest"), windows=CASES[0][0])
    plan = admitted._jdf.queryExecution().analyzed()
    while plan.nodeName() != "FlatMapGroupsInPandasWithState":
        plan = plan.children().apply(0)
    sent = plan.child().output()
    names = {sent.apply(i).name() for i in range(sent.size())}
    assert names == {"id", "key", "uid", "digest", "force", "_key", "_at", "_digest", "_missing0", "_clock", "_group"}


def test_stream_keeps_longs_and_times_exact(spark, folder):
    """Missing ones among them, and times that nanoseconds cannot tell."""
    rows = [
        (1, "a", BASE, 2**60 + 1, datetime(1500, 1, 1, tzinfo=timezone.utc)),
        (None, "a", BASE, None, None),
        (3, "a", BASE + timedelta(hours=1), 2**62 + 3, datetime(9000, 6, 1, 1, 2, 3, 4, tzinfo=timezone.utc)),
        (4, "b", None, 5, BASE),
    ]
    df = spark.createDataFrame(rows, "id bigint, key string, ts timestamp, big bigint, seen timestamp").coalesce(1)
    df.write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{folder}/in")
    drained(admit_stateful(stream, F.col("key"), "ts", order=["id"], windows=CASES[0][0]), folder)
    out = spark.read.parquet(f"{folder}/out")
    assert sorted(map(str, out.select(df.columns).collect())) == sorted(map(str, df.collect()))
    # A missing value comes last among equal times.
    assert {r.id: r.status for r in out.collect()} == {1: "accepted", None: "double_tap", 3: "accepted", 4: "undated"}


@pytest.mark.parametrize("seed", range(2))
def test_stream_with_late_events_and_changing_windows(spark, folder, seed):
    """Each event brings its own windows; some of a later file are older than what was accepted."""
    patient, hasty = CASES[0][0], Windows(timedelta(seconds=2), timedelta(seconds=30), timedelta(hours=2), timedelta(seconds=9))
    rows = make_events(700, 9, 1500, seed=51 + seed, hot=0.4)
    even = F.col("id") % 2 == 0
    mixed = {n: F.when(even, a).otherwise(hasty.columns()[n]) for n, a in patient.columns().items()}
    cuts = [(0, 600), (540, 1000), (940, 1500)]
    ledger, expected, rest = [], {}, rows
    for low, high in cuts:
        # The overlaps are dealt by id.
        part = [r for r in rest if r[2] < BASE + timedelta(seconds=high) and (r[0] % 3 or r[2] < BASE + timedelta(seconds=high - 60))]
        rest = [r for r in rest if r not in part]
        for row in sorted(part, key=lambda r: (r[1], r[2], r[0])):
            expected |= walk([row], patient if row[0] % 2 == 0 else hasty, ledger)
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        drained(stateful(spark.readStream.schema(SCHEMA).parquet(f"{folder}/in"), mixed), folder)
    assert collected(spark.read.parquet(f"{folder}/out")) == expected
    assert any(status == "late" for status, *_ in expected.values())
