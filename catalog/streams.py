"""I1, I2, I7 and I8 as Structured Streaming queries."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from dockline.session import scratch
from dockline.sinks.table import read_table
from dockline.streaming.admission import admit_stateful, late_events
from dockline.streaming.continuous import ContinuousLoad
from dockline.streaming.ingest import event_stream, routed_stream

from . import query
from .admission import DAY, EVENTS_SQL, admission_sql, answers, narrow
from .fixtures import monthly_orders, objects, orders, rules
from .loads import MONTHLY_SQL, monthly, months_into
from .routing import PAIRS_SQL


def drain(stream, path):
    """Run a stream over everything there is, into files."""
    (
        stream.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", f"{path}-checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return path


@query(
    "stream_ingest",
    f"SELECT name, job, count(*) AS n FROM ({PAIRS_SQL}) WHERE auto_trigger GROUP BY 1, 2",
)
def stream_ingest(spark, sf_dir):
    """Events arrive as files of JSON lines and leave with the rules they start."""
    incoming, out = scratch(spark, "incoming"), scratch(spark, "routed")
    objects(spark, sf_dir).select(F.to_json(F.struct("bucket", "name")).alias("value")).repartition(4).write.text(incoming)
    drain(routed_stream(event_stream(spark, incoming, files_per_trigger=2), rules(spark)), out)
    return spark.read.parquet(out).groupBy("name", "job").agg(F.count(F.lit(1)).alias("n"))


def admitted_in_turn(spark, parts, **options):
    """Parts arrive one after the other; the stream is drained, and started again, after each.

    Parts are written and read by as many tasks as they need: a micro-batch is a part.
    """
    path, out = scratch(spark, "arrivals"), scratch(spark, "admitted")
    for part in parts:
        part.write.mode("append").parquet(path)
        stream = spark.readStream.schema(part.schema).parquet(path)
        drain(
            admit_stateful(
                stream, F.col("user_id"), "ts", order=["event_id"], content_hash=F.col("event_type"), windows=DAY, **options
            ),
            out,
        )
    return spark.read.parquet(out)


def periods(spark, sf_dir, cuts):
    """The events between the cuts, in time order."""
    events = narrow(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))
    for low, high in zip([None, *cuts], [*cuts, None]):
        yield events.filter((F.lit(low is None) | (F.col("ts") >= F.lit(low))) & (F.lit(high is None) | (F.col("ts") < F.lit(high))))


@query("admit_events_stream", admission_sql(EVENTS_SQL, DAY))
def admit_events_stream(spark, sf_dir):
    """The stateful stream gives every event the answer of the batch."""
    return answers(admitted_in_turn(spark, periods(spark, sf_dir, ["2024-01-08", "2024-01-15", "2024-01-22"])))


# Every event arrives again at the end, weeks behind the watermark. Of a user whose last task
# has expired by then nothing is known, so all of their events are late and have no task times;
# else an event is late if one after it was accepted.
@query(
    "late_events",
    f"""
    SELECT -e.event_id - 1 AS event_id, 'late' AS status,
           CASE WHEN known THEN created_us END AS created_us, CASE WHEN known THEN scheduled_us END AS scheduled_us,
           CASE WHEN known THEN cooldown_us END AS cooldown_us, CASE WHEN known THEN expire_us END AS expire_us
    FROM events e JOIN (
      SELECT user_id, max(created_us) AS created_us, max(scheduled_us) AS scheduled_us,
             max(cooldown_us) AS cooldown_us, max(expire_us) AS expire_us,
             max(expire_us) // 1000 >= (SELECT (max(epoch_us(ts)) - 3600000000) // 1000 FROM events) AS known
      FROM ({admission_sql(EVENTS_SQL, DAY)}) JOIN events USING (event_id) GROUP BY 1
    ) USING (user_id)
    WHERE epoch_us(e.ts) < created_us OR NOT known
    """,
)
def late_events_query(spark, sf_dir):
    again = narrow(spark, sf_dir).withColumn("ts", F.col("ts").cast("timestamp")).withColumn("event_id", -F.col("event_id") - 1)
    parts = [*periods(spark, sf_dir, ["2024-01-15"]), again]
    return late_events(answers(admitted_in_turn(spark, parts)))


@query("continuous_load", MONTHLY_SQL)
def continuous_load(spark, sf_dir):
    """Marker events of all months arrive in three files; each loads its month."""
    root = monthly_orders(spark, sf_dir)
    incoming, target = scratch(spark, "incoming"), scratch(spark, "table")
    month = F.date_format("o_orderdate", "yyyyMM")
    months = orders(spark, sf_dir).select(month.alias("month")).distinct()
    event = F.to_json(
        F.struct(
            F.lit("warehouse").alias("bucket"),
            F.concat(F.lit("daily/data/"), F.col("month"), F.lit("/DONE")).alias("name"),
            F.lit("1").alias("generation"),
            F.concat_ws("-", F.substring("month", 1, 4), F.substring("month", 5, 2), F.lit("28")).alias("time_created"),
        )
    )
    months.select(event.alias("value")).repartition(3).write.text(incoming)
    registry = spark.createDataFrame(
        [("orders", "warehouse", r"^daily/data/\d{6}/DONE$", "marker", True, "PT30S", "PT30M", "P1D", "PT5M", 0)],
        "name string, source_bucket string, source_prefix string, mode string, auto_trigger boolean, "
        "double_tap_window string, cooldown_window string, ttl_buffer string, schedule_delay string, ordinal bigint",
    )
    base = root.removesuffix("daily/data")
    loader = ContinuousLoad(
        spark,
        state=scratch(spark, "state"),
        rules=registry,
        loads={"orders": months_into(target, mode="partition_range")},
        locate=lambda bucket, path: f"{base}{path.rstrip('/')}",
    )
    loader.start(incoming, files_per_trigger=1).awaitTermination()
    # What was accepted last is due later than any event.
    loader.run_tasks(datetime.now(timezone.utc))
    return monthly(read_table(spark, target, with_part_id=True))
