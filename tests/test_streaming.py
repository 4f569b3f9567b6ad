"""The continuous load: late, repeated, broken and replayed input."""

from __future__ import annotations

import json
import os
import time
from datetime import datetime, timezone

import pytest

from dockline.sinks.table import read_table
from dockline.streaming.continuous import ContinuousLoad
from dockline.streaming.ingest import event_stream, routed_stream

from .test_loads import spec, write_days

RULES = (
    "name string, source_bucket string, source_prefix string, mode string, auto_trigger boolean, double_tap_window string, "
    "cooldown_window string, ttl_buffer string, schedule_delay string, ordinal bigint"
)


def event(day, at, generation="1", **more):
    return json.dumps(dict(bucket="b", name=f"daily/{day}/DONE", generation=generation, time_created=at, **more))


def arrive(folder, number, lines):
    os.makedirs(f"{folder}/events", exist_ok=True)
    path = f"{folder}/events/{number}.json"
    with open(path, "w") as file:
        file.write("\n".join(lines) + "\n")
    os.utime(path, (1_700_000_000 + number, 1_700_000_000 + number))


@pytest.fixture
def loader(spark, folder):
    rules = spark.createDataFrame(
        [("days", "b", r"^daily/\d{8}/DONE$", "marker", True, "PT30S", "PT30M", "PT1H", "PT10M", 0)], RULES
    )
    write_days(f"{folder}/in/daily", ["20240101", "20240102", "20240103"])
    return ContinuousLoad(
        spark,
        state=f"{folder}/state",
        rules=rules,
        loads={"days": spec(f"{folder}/table", mode="partition_range", audit_path=f"{folder}/audit")},
        locate=lambda bucket, path: f"{folder}/in/{path.rstrip('/')}",
    )


def drain(loader, folder):
    loader.start(f"{folder}/events", files_per_trigger=1).awaitTermination()


def statuses(loader):
    rows = loader.decisions().select("name", "at", "event_uid", "status", "batch_id").collect()
    return sorted((r.name.split("/")[1], str(r.at)[11:], r.event_uid.rsplit("/", 1)[1], r.status, r.batch_id) for r in rows)


def test_from_event_to_table(spark, folder, loader):
    arrive(folder, 0, [
        event("20240101", "2024-01-05T10:00:00Z"),
        event("20240101", "2024-01-05T10:00:00Z"),
        event("20240101", "2024-01-05T10:00:10Z", "2"),
        event("20240102", "2024-01-05T10:05:00Z"),
        '{"bucket": "b"}',
        "not json",
        json.dumps(dict(bucket="b", name="elsewhere/file")),
        json.dumps(dict(bucket="b", name="")),
    ])
    arrive(folder, 1, [
        event("20240101", "2024-01-05T10:09:00Z", "3"),
        # The first task is due by now, the second is not.
        event("20240103", "2024-01-05T10:12:00Z"),
    ])
    arrive(folder, 2, [
        # Late, then fine, then forced.
        event("20240103", "2024-01-05T10:11:00Z", "0"),
        event("20240101", "2024-01-05T10:13:00Z", "4"),
        event("20240102", "2024-01-05T10:14:00Z", "9", force_run=True),
    ])
    drain(loader, folder)
    assert statuses(loader) == [
        ("20240101", "10:00:00", "1", "accepted", 0),
        ("20240101", "10:00:00", "1", "duplicate_event", 0),
        ("20240101", "10:00:10", "2", "double_tap", 0),
        ("20240101", "10:09:00", "3", "pending", 1),
        ("20240101", "10:13:00", "4", "accepted", 2),
        ("20240102", "10:05:00", "1", "accepted", 0),
        ("20240102", "10:14:00", "9", "accepted", 2),
        ("20240103", "10:11:00", "0", "late", 2),
        ("20240103", "10:12:00", "1", "accepted", 1),
    ]
    assert [r.name for r in loader.late().collect()] == ["daily/20240103/DONE"]
    rejected = spark.read.parquet(f"{folder}/state/rejected")
    assert sorted(r.reasons[0] for r in rejected.collect()) == ["malformed", "missing:name"]
    assert spark.read.parquet(f"{folder}/state/nameless").count() == 1
    runs = spark.read.json(f"{folder}/audit").select("run_uuid", "partitions").collect()
    assert sorted((r.run_uuid, tuple(r.partitions)) for r in runs) == [("days-1", ("20240101",)), ("days-2", ("20240102",))]
    table = read_table(spark, f"{folder}/table", with_part_id=True)
    assert {r.part_id: r["count"] for r in table.groupBy("part_id").count().collect()} == {"20240101": 3, "20240102": 3}


def test_a_replayed_batch_leaves_the_same_state(spark, folder, loader):
    lines = [event("20240101", "2024-01-05T10:00:00Z"), event("20240102", "2024-01-05T10:20:00Z")]
    first = spark.createDataFrame([(line,) for line in lines], "value string")
    second = spark.createDataFrame([(event("20240101", "2024-01-05T10:21:00Z", "2"),)], "value string")
    loader.process(first, 0)
    loader.process(second, 1)
    before = (statuses(loader), sorted(map(tuple, spark.read.parquet(f"{folder}/state/runs").collect())))
    loader.process(second, 1)
    assert (statuses(loader), sorted(map(tuple, spark.read.parquet(f"{folder}/state/runs").collect()))) == before
    assert [s[3] for s in before[0]] == ["accepted"] * 3


def lines_of(spark, *lines):
    return spark.createDataFrame([(line,) for line in lines], "value string")


def days_in(folder, table):
    return sorted(os.listdir(f"{folder}/state/{table}")) if os.path.exists(f"{folder}/state/{table}") else []


def test_expired_days_disappear_without_a_call(spark, folder, loader):
    """Over a stream of three files; a day goes when its last task could have expired."""
    arrive(folder, 0, [event("20240101", "2024-01-05T10:00:00Z")])
    arrive(folder, 1, [event("20240102", "2024-01-06T01:00:00Z")])
    drain(loader, folder)
    held = lambda t: [d for d in days_in(folder, t) if d.startswith("day=")]
    assert held("ledger") == ["day=2024-01-05", "day=2024-01-06"]
    arrive(folder, 2, [event("20240103", "2024-01-06T02:00:00Z")])
    drain(loader, folder)
    # Midnight plus double tap, cooldown and an hour of buffer is past.
    assert held("ledger") == held("decisions") == ["day=2024-01-06"] and held("runs") in ([], ["day=2024-01-06"])
    assert {s[4] for s in statuses(loader)} == {1, 2}
    assert [d for d in days_in(folder, "clock") if d.startswith("batch")] == ["batch_id=1", "batch_id=2"]


def test_a_batch_opens_only_the_days_of_its_look_back(spark, folder, loader):
    """Fifty batches over as many days; the plan of the next reads the last day only."""
    ledger = loader._days
    for batch in range(50):
        day = f"2024-{1 + batch // 28:02}-{1 + batch % 28:02}"
        rows = spark.sql(
            f"SELECT 'days|b/{batch % 5}' AS task_key, 'u' AS event_uid, 'h' AS content_hash, timestamp'{day} 10:00:00' AS created_at,"
            f" timestamp'{day} 10:10:00' AS scheduled_at, timestamp'{day} 10:30:30' AS cooldown_until,"
            f" timestamp'{day} 11:30:30' AS expire_at, '{batch}' AS task_id, 'days' AS job"
        )
        loader._write_days(rows.coalesce(1), "ledger", batch)
    at = int(datetime(2024, 2, 22, 10, 20, tzinfo=timezone.utc).timestamp()) * 10**6
    last = loader.look_back(at - 30 * 60 * 10**6, 50)
    assert [r.task_id for r in last.collect()] == ["49"]
    assert [f.split("/state/ledger/")[1].rsplit("/", 1)[0] for f in last.inputFiles()] == ["day=2024-02-22/batch_id=49"]
    plan = last._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan
    assert ledger("ledger").count() == 50


def test_closed_days_are_compacted(spark, folder, loader):
    """The last record of each key stays, a failure half way leaves nothing wrong."""
    for batch, at in enumerate(["10:00", "11:00", "12:00"]):
        loader.process(lines_of(spark, event("20240101", f"2024-01-05T{at}:00Z", str(batch))), batch)
    loader.process(lines_of(spark, event("20240102", "2024-01-05T23:58:00Z")), 3)
    loader.process(lines_of(spark, event("20240103", "2024-01-06T00:01:00Z")), 4)
    held = [d for d in days_in(folder, "ledger/day=2024-01-05") if d.startswith("batch")]
    assert held == ["batch_id=-5"]
    rows = loader._days("ledger").orderBy("created_at").collect()
    assert [r.name.split("/")[1] for r in rows] == ["20240101", "20240102", "20240103"] and rows[0].created_at.hour == 12
    # The task of 23:58 was still to run when its day was compacted.
    loader.process(lines_of(spark, event("20240103", "2024-01-06T00:09:00Z", "2")), 5)
    assert read_table(spark, f"{folder}/table").where("day = '20240102'").count() == 3
    loader.process(lines_of(spark, event("20240103", "2024-01-06T00:09:00Z", "2")), 5)
    assert [s[3] for s in statuses(loader) if s[4] == 5] == ["pending"]


def test_a_timer_runs_the_last_task(spark, folder, loader):
    """No event comes after the one that is accepted last."""
    loader.run_due = False
    arrive(folder, 0, [event("20240101", "2024-01-05T10:00:00Z"), event("20240102", "2024-01-05T10:30:00Z")])
    drain(loader, folder)
    assert not os.path.exists(f"{folder}/table")
    timer = loader.start_timer("1 second")
    try:
        for _ in range(120):
            if len([d for d in days_in(folder, "runs") if d.startswith("day")]):
                break
            time.sleep(0.5)
    finally:
        timer.stop()
    table = read_table(spark, f"{folder}/table", with_part_id=True)
    assert {r.part_id: r["count"] for r in table.groupBy("part_id").count().collect()} == {"20240101": 3, "20240102": 3}
    runs = loader._days("runs")
    assert runs.count() == 2
    loader.run_tasks(datetime.now(timezone.utc))
    assert loader._days("runs").count() == 2


def test_a_missing_folder_is_refused_and_the_rest_loads(spark, folder, loader):
    rules = spark.createDataFrame(
        [
            ("days", "b", r"^daily/\d{8}/DONE$", "marker", True, "PT30S", "PT30M", "PT1H", "PT10M", 0, ["{{ source_prefix }}", "--run_uuid=x"]),
            ("others", "b", r"^other/\d{8}$", "folder", True, "PT30S", "PT30M", "PT1H", "PT10M", 1, []),
        ],
        RULES + ", args array<string>",
    )
    names = ["daily/20240101/DONE", "daily/20240101/part.csv", "other/20240105"]
    loader.rules = rules
    loader.manifest = spark.createDataFrame([("b", n) for n in names], "bucket string, name string")
    loader.loads["others"] = spec(f"{folder}/others", mode="partition_range")
    other = lambda day: json.dumps(dict(bucket="b", name=f"other/{day}", generation="1", time_created="2024-01-05T10:00:00Z"))
    loader.process(lines_of(spark, event("20240101", "2024-01-05T10:00:00Z"), event("20240109", "2024-01-05T10:00:00Z"), other("20240105")), 0)
    loader.process(lines_of(spark, event("20240102", "2024-01-05T10:30:00Z")), 1)
    refused = {(r.job, r.name): r.error for r in loader._days("refused").collect()}
    assert refused[("days", "daily/20240109/DONE")] == "path not found"
    runs = loader._days("runs").collect()
    assert [(r.job, r.path) for r in runs] == [("days", "daily/20240101/")]
    assert runs[0].args == ["daily/20240101/", f"--run_uuid={runs[0].task_id}"]
    assert read_table(spark, f"{folder}/table").count() == 3


def test_events_without_a_time_keep_their_arrival(spark, folder, loader):
    bare = json.dumps(dict(bucket="b", name="daily/20240101/DONE", generation="1"))
    loader.process(lines_of(spark, bare), 0)
    before = loader.decisions().select("at", "created_at").collect()
    loader.process(lines_of(spark, bare), 0)
    assert loader.decisions().select("at", "created_at").collect() == before


def test_routed_stream(spark, folder):
    rules = spark.createDataFrame(
        [(0, "one", "b", "^daily/", "file", True), (1, "two", "b", "DONE$", "marker", True), (2, "off", "b", ".", "file", False)],
        "ordinal bigint, name string, source_bucket string, source_prefix string, mode string, auto_trigger boolean",
    )
    arrive(folder, 0, [event("20240101", "x"), "broken"])
    arrive(folder, 1, [json.dumps(dict(bucket="c", name="daily/x"))])
    stream = routed_stream(event_stream(spark, f"{folder}/events", 1), rules)
    assert stream.isStreaming
    query = (
        stream.writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.job for r in spark.read.parquet(f"{folder}/out").collect()) == ["one", "two"]
