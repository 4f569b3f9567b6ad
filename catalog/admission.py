"""I2 to I6: admission in batch, its times and its ledger."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from dockline.functions.durations import schedule_times
from dockline.operators.admission import Windows, admit, window_columns
from dockline.operators.ledger import due_tasks, expire_ledger, latest_per_key, ledger_records

from . import query
from .fixtures import table

DAY = Windows(double_tap=timedelta(seconds=5), cooldown=timedelta(hours=24), ttl=timedelta(hours=12), delay=timedelta(hours=4))

EVENTS_SQL = "SELECT event_id, user_id AS key, ts, CAST(NULL AS VARCHAR) AS uid, event_type AS digest, FALSE AS force FROM events"


def admission_sql(events: str, windows: Windows) -> str:
    """The outcome of every event, one step of the recursion per event of a key."""
    # A window of zero stands for the default, whichever it is.
    own, usual = ((w.double_tap, w.cooldown, w.ttl, w.delay) for w in (windows, Windows()))
    dt, cd, ttl, delay = ((w or default) // timedelta(microseconds=1) for w, default in zip(own, usual))
    return f"""
    WITH RECURSIVE e AS (
      SELECT *, epoch_us(ts) AS t, row_number() OVER (PARTITION BY key ORDER BY ts, event_id) AS n FROM ({events})
    ), r AS (
      SELECT key, n, event_id, 'accepted' AS status, t AS created, CASE WHEN force THEN t ELSE t + {delay} END AS scheduled,
             greatest(t + {dt + cd}, CASE WHEN force THEN t ELSE t + {delay} END) AS until, uid AS last_uid, digest AS last_digest
      FROM e WHERE n = 1
      UNION ALL
      SELECT key, n, event_id, status,
             CASE WHEN status = 'accepted' THEN t ELSE created END,
             CASE WHEN status <> 'accepted' THEN scheduled WHEN force THEN t ELSE t + {delay} END,
             CASE WHEN status <> 'accepted' THEN until
                  ELSE greatest(t + {dt + cd}, CASE WHEN force THEN t ELSE t + {delay} END) END,
             CASE WHEN status = 'accepted' THEN uid ELSE last_uid END,
             CASE WHEN status = 'accepted' THEN digest ELSE last_digest END
      FROM (
        SELECT e.key, e.n, e.event_id, e.t, e.force, e.uid, e.digest, r.created, r.scheduled, r.until, r.last_uid, r.last_digest,
               CASE WHEN r.created < e.t - {cd} THEN 'accepted'
                    WHEN e.uid = r.last_uid THEN 'duplicate_event'
                    WHEN e.t < r.created + {dt} THEN 'double_tap'
                    WHEN e.force THEN 'accepted'
                    WHEN e.t < r.scheduled THEN 'pending'
                    WHEN e.t < r.until AND e.uid IS NULL AND e.digest IS NOT DISTINCT FROM r.last_digest THEN 'cooldown'
                    ELSE 'accepted' END AS status
        FROM r JOIN e ON e.key = r.key AND e.n = r.n + 1
      )
    )
    SELECT event_id, status, created AS created_us, scheduled AS scheduled_us, until AS cooldown_us, until + {ttl} AS expire_us FROM r
    """


def answers(df):
    return df.select(
        "event_id",
        "status",
        F.unix_micros("created_at").alias("created_us"),
        F.unix_micros("scheduled_at").alias("scheduled_us"),
        F.unix_micros("cooldown_until").alias("cooldown_us"),
        F.unix_micros("expire_at").alias("expire_us"),
    )


def run(events, windows, *, key="user_id", uid=None, digest=None, force=None, slices=None):
    return admit(
        events,
        F.col(key),
        F.col("ts"),
        order=["event_id"],
        uid=uid,
        content_hash=digest,
        force=force,
        windows=windows,
        slices=slices,
    )


def narrow(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")


@query("admit_events", admission_sql(EVENTS_SQL, DAY))
def admit_events(spark, sf_dir):
    return answers(run(narrow(spark, sf_dir), DAY, digest=F.col("event_type")))


# Every event twice, the copy one second later under the same id.
TWICE_SQL = """
SELECT event_id * 2 + c AS event_id, user_id AS key, ts + to_seconds(c) AS ts, CAST(event_id AS VARCHAR) AS uid,
       event_type AS digest, FALSE AS force
FROM events, (VALUES (0), (1)) AS copies(c)
"""


@query("admit_duplicate", admission_sql(TWICE_SQL, Windows()))
def admit_duplicate(spark, sf_dir):
    events = narrow(spark, sf_dir).withColumn("uid", F.col("event_id").cast("string"))
    copies = F.explode(F.array(F.lit(0), F.lit(1))).alias("c")
    twice = events.select("*", copies).select(
        (F.col("event_id") * 2 + F.col("c")).alias("event_id"),
        "user_id",
        (F.col("ts") + F.make_dt_interval(secs=F.col("c").cast("decimal(18,6)"))).alias("ts"),
        "uid",
        "event_type",
    )
    return answers(run(twice, Windows(), uid=F.col("uid"), digest=F.col("event_type")))


UID_SQL = "SELECT event_id, user_id AS key, ts, CAST(event_id AS VARCHAR) AS uid, event_type AS digest, {} AS force FROM events"
TAPS = Windows(double_tap=timedelta(hours=2), cooldown=timedelta(hours=24), delay=timedelta(minutes=5))
WAITS = Windows(cooldown=timedelta(days=3), delay=timedelta(hours=30))
CALM = Windows(cooldown=timedelta(hours=36), delay=timedelta(0))


@query("admit_double_tap", admission_sql(UID_SQL.format("event_type = 'signup'"), TAPS))
def admit_double_tap(spark, sf_dir):
    """A double tap stops forced runs too."""
    events = narrow(spark, sf_dir).withColumn("force", F.col("event_type") == "signup")
    found = run(events, TAPS, uid=F.col("event_id"), digest=F.col("event_type"), force=F.col("force"))
    return answers(found)


@query("admit_pending", admission_sql(UID_SQL.format("FALSE"), WAITS))
def admit_pending(spark, sf_dir):
    return answers(run(narrow(spark, sf_dir), WAITS, uid=F.col("event_id"), digest=F.col("event_type")))


@query("admit_cooldown", admission_sql(EVENTS_SQL, CALM))
def admit_cooldown(spark, sf_dir):
    return answers(run(narrow(spark, sf_dir), CALM, digest=F.col("event_type")))


@query(
    "admit_force_run",
    admission_sql(EVENTS_SQL.replace("FALSE AS force", "event_type = 'click' AS force"), WAITS),
)
def admit_force_run(spark, sf_dir):
    events = narrow(spark, sf_dir).withColumn("force", F.col("event_type") == "click")
    return answers(run(events, WAITS, digest=F.col("event_type"), force=F.col("force")))


HOT_SQL = EVENTS_SQL.replace("user_id AS key", "CASE WHEN user_id % 3 = 0 THEN -1 ELSE user_id END AS key")


@query("admit_hot_key", admission_sql(HOT_SQL, DAY))
def admit_hot_key(spark, sf_dir):
    """A third of all events under one key, cut into slices."""
    hot = F.when(F.col("user_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id"))
    events = narrow(spark, sf_dir).withColumn("key", hot)
    return answers(run(events, DAY, key="key", digest=F.col("event_type"), slices=16))


@query(
    "schedule_times",
    """
    SELECT event_id, t + CASE WHEN f THEN 0 ELSE 300000000 END AS scheduled_us,
           greatest(t + 1805000000, t + CASE WHEN f THEN 0 ELSE 300000000 END) AS cooldown_us,
           greatest(t + 1805000000, t + CASE WHEN f THEN 0 ELSE 300000000 END) + 43200000000 AS expire_us
    FROM (SELECT event_id, epoch_us(ts) AS t, event_type = 'signup' AS f FROM events)
    """,
)
def schedule_times_query(spark, sf_dir):
    w = Windows().columns()
    times = schedule_times(
        F.col("ts").cast("timestamp"),
        F.col("event_type") == "signup",
        w["_double_tap"],
        w["_cooldown"],
        w["_delay"],
        w["_ttl"],
    )
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.unix_micros(times["scheduled_at"]).alias("scheduled_us"),
        F.unix_micros(times["cooldown_until"]).alias("cooldown_us"),
        F.unix_micros(times["expire_at"]).alias("expire_us"),
    )


@query(
    "window_defaults",
    """
    SELECT event_id, coalesce(nullif(w, 0), 5000000) AS double_tap, coalesce(nullif(w, 0), 1800000000) AS cooldown,
           coalesce(nullif(w, 0), 43200000000) AS ttl, coalesce(nullif(w, 0), 300000000) AS delay
    FROM (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 WHEN event_id % 3 = 1 THEN user_id * 1000000 END AS w FROM events)
    """,
)
def window_defaults(spark, sf_dir):
    key = F.col("event_id") % 3
    window = F.when(key == 0, F.lit(0)).when(key == 1, F.col("user_id") * 1_000_000).cast("bigint")
    columns = window_columns(window, window, window, window)
    return table(spark, sf_dir, "events").select(
        "event_id", *(column.alias(name.lstrip("_")) for name, column in columns.items())
    )


def ledger(spark, sf_dir):
    """The tasks of an admission run over all events."""
    events = narrow(spark, sf_dir).withColumn("task_key", F.col("user_id").cast("string"))
    events = events.withColumn("event_uid", F.col("event_id").cast("string"))
    return ledger_records(run(events, DAY, digest=F.col("event_type")))


LEDGER_SQL = f"SELECT * FROM ({admission_sql(EVENTS_SQL, DAY)}) WHERE status = 'accepted'"
NOW_SQL = "epoch_us(TIMESTAMP '2024-01-15 12:00:00')"


@query("due_tasks", f"SELECT event_id FROM ({LEDGER_SQL}) WHERE scheduled_us <= {NOW_SQL}")
def due_tasks_query(spark, sf_dir):
    return due_tasks(ledger(spark, sf_dir), F.lit("2024-01-15 12:00:00").cast("timestamp")).select("event_id")


@query("expire_ledger", f"SELECT event_id FROM ({LEDGER_SQL}) WHERE expire_us > {NOW_SQL}")
def expire_ledger_query(spark, sf_dir):
    return expire_ledger(ledger(spark, sf_dir), F.lit("2024-01-15 12:00:00").cast("timestamp")).select("event_id")


# The second half of the month is admitted against the ledger of the first.
@query("admit_with_ledger", admission_sql(EVENTS_SQL, DAY))
def admit_with_ledger(spark, sf_dir):
    events = narrow(spark, sf_dir).withColumn("task_key", F.col("user_id").cast("string"))
    cut = F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    first = run(events.filter(F.col("ts") < cut), DAY, digest=F.col("event_type"))
    records = ledger_records(first.withColumn("event_uid", F.lit(None).cast("string"))).withColumnRenamed(
        "event_type", "content_hash"
    )
    second = admit(
        events.filter(F.col("ts") >= cut),
        F.col("task_key"),
        F.col("ts"),
        order=["event_id"],
        content_hash=F.col("event_type"),
        windows=DAY,
        last=latest_per_key(records, tie=["task_id"]),
    )
    return answers(first.unionByName(second))
