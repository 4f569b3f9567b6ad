"""Section H, J2 and K1: writing tables and whole loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockline.plans.load import LoadSpec, convert_format, quarantine_sink, run_load
from dockline.session import scratch
from dockline.sinks.table import (
    TableSpec,
    overwrite_partition,
    overwrite_partition_range,
    overwrite_table,
    read_table,
)
from dockline.sources.events import parse_events, rejected_records
from dockline.sources.scan import normalize_timestamps, scan

from . import query
from .fixtures import (
    CENTS_SQL,
    ORDERS_SQL,
    ORDERS_TEXT_SCHEMA,
    cents,
    flat_orders,
    monthly_orders,
    order_rows,
    orders,
    plain_folders,
    table,
)
from .scans import event_texts

MONTHS = LoadSpec(
    job="orders",
    fmt="delimited",
    delimiter=",",
    schema=ORDERS_TEXT_SCHEMA,
    partition_regex=r"^/(\d{6})(?:/|$)",
    partition_format="%Y%m",
    path_root="/daily/data",
    table=TableSpec(path="", granularity="MONTH"),
)


def months_into(target: str, **changes) -> LoadSpec:
    return LoadSpec(**{**MONTHS.__dict__, "table": TableSpec(path=target, granularity="MONTH"), **changes})


MONTHLY_SQL = f"""
SELECT strftime(o_orderdate, '%Y%m') AS part_id, count(*) AS n, {CENTS_SQL.format('o_totalprice')} AS total
FROM orders GROUP BY 1
"""


def monthly(df):
    return df.groupBy("part_id").agg(F.count(F.lit(1)).alias("n"), cents("o_totalprice").alias("total"))


@query("overwrite_table", MONTHLY_SQL)
def overwrite_table_query(spark, sf_dir):
    """Dated CSV folders to a monthly table, read back."""
    root = monthly_orders(spark, sf_dir)
    target = scratch(spark, "table")
    run_load(spark, months_into(target), root, "run-1")
    return monthly(read_table(spark, target, with_part_id=True))


@query(
    "overwrite_table_again",
    f"""
    SELECT strftime(o_orderdate, '%Y%m') AS part_id, count(*) AS n, {CENTS_SQL.format('o_totalprice')} AS total
    FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY 1
    """,
)
def overwrite_table_again(spark, sf_dir):
    """A second load with fewer months leaves none of the first behind."""
    target = TableSpec(path=scratch(spark, "table"), partition_column="o_orderdate", granularity="MONTH")
    df = normalize_timestamps(orders(spark, sf_dir))
    overwrite_table(df, target)
    overwrite_table(df.filter("o_orderdate >= TIMESTAMP '1998-01-01'"), target)
    return monthly(read_table(spark, target.path, with_part_id=True))


@query("overwrite_partition_range", MONTHLY_SQL)
def overwrite_partition_range_query(spark, sf_dir):
    """Twelve months are loaded again, twice; nothing doubles, the rest stays."""
    root = monthly_orders(spark, sf_dir)
    target = scratch(spark, "table")
    run_load(spark, months_into(target), root, "run-1")
    ranged = months_into(target, mode="partition_range")
    for number in (2, 3):
        run_load(spark, ranged, f"{root}/1997*", f"run-{number}")
    return monthly(read_table(spark, target, with_part_id=True))


@query(
    "overwrite_partition",
    f"""
    SELECT strftime(o_orderdate, '%Y%m') AS part_id, count(*) AS n, {CENTS_SQL.format('o_totalprice')} AS total
    FROM orders WHERE strftime(o_orderdate, '%Y%m') <> '199802' GROUP BY 1
    UNION ALL
    SELECT '199802', count(*), {CENTS_SQL.format('o_totalprice')} FROM orders WHERE strftime(o_orderdate, '%Y%m') = '199801'
    """,
)
def overwrite_partition_query(spark, sf_dir):
    """February's partition gets January's rows, then March is replaced by itself."""
    root = monthly_orders(spark, sf_dir)
    target = scratch(spark, "table")
    run_load(spark, months_into(target), root, "run-1")
    single = months_into(target, mode="partition")
    run_load(spark, single, f"{root}/199803", "run-2")
    january = scan(spark, f"{root}/199801", "delimited", delimiter=",", schema=ORDERS_TEXT_SCHEMA)
    overwrite_partition(january, single.table, "1998-02-01")
    return monthly(read_table(spark, target, with_part_id=True))


@query(
    "overwrite_partition_empty",
    f"""
    SELECT strftime(o_orderdate, '%Y%m') AS part_id, count(*) AS n, {CENTS_SQL.format('o_totalprice')} AS total
    FROM orders WHERE strftime(o_orderdate, '%Y%m') <> '199802' GROUP BY 1
    """,
)
def overwrite_partition_empty(spark, sf_dir):
    """An empty load empties its partition."""
    target = TableSpec(path=scratch(spark, "table"), partition_column="o_orderdate", granularity="MONTH")
    df = normalize_timestamps(orders(spark, sf_dir))
    overwrite_table(df, target)
    overwrite_partition(df.filter("o_orderkey < 0"), target, "1998-02-01")
    return monthly(read_table(spark, target.path, with_part_id=True))


@query(
    "partition_granularity",
    """
    SELECT 'hour' AS unit, strftime(ts, '%Y%m%d%H') AS part_id, count(*) AS n FROM events GROUP BY 2
    UNION ALL SELECT 'day', strftime(ts, '%Y%m%d'), count(*) FROM events GROUP BY 2
    UNION ALL SELECT 'month', strftime(ts, '%Y%m'), count(*) FROM events GROUP BY 2
    UNION ALL SELECT 'year', strftime(ts, '%Y'), count(*) FROM events GROUP BY 2
    """,
)
def partition_granularity(spark, sf_dir):
    events = normalize_timestamps(table(spark, sf_dir, "events"))
    parts = []
    for unit in ("HOUR", "DAY", "MONTH", "YEAR"):
        target = TableSpec(
            path=scratch(spark, "table"),
            partition_column="ts",
            granularity=unit,
            tasks=spark.sparkContext.defaultParallelism,
        )
        overwrite_table(events, target)
        written = read_table(spark, target.path, with_part_id=True)
        parts.append(written.groupBy(F.lit(unit.lower()).alias("unit"), "part_id").agg(F.count(F.lit(1)).alias("n")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "read_partitions_between",
    "SELECT event_id, user_id FROM events WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-13'",
)
def read_partitions_between(spark, sf_dir):
    target = TableSpec(path=scratch(spark, "table"), partition_column="ts", granularity="DAY")
    overwrite_table(normalize_timestamps(table(spark, sf_dir, "events")), target)
    return read_table(spark, target.path, between=("20240110", "20240112")).select("event_id", "user_id")


@query(
    "clustering",
    "SELECT strftime(ts, '%Y%m%d') AS part_id, count(*) AS n, min(user_id) AS low, max(user_id) AS high FROM events GROUP BY 1",
)
def clustering(spark, sf_dir):
    target = TableSpec(
        path=scratch(spark, "table"), partition_column="ts", granularity="DAY", cluster_by=("user_id", "event_type")
    )
    overwrite_table(normalize_timestamps(table(spark, sf_dir, "events")), target)
    written = read_table(spark, target.path, with_part_id=True)
    return written.groupBy("part_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("user_id").alias("low"), F.max("user_id").alias("high")
    )


@query(
    "allow_field_addition",
    """
    SELECT o_orderkey, o_orderstatus,
           CASE WHEN strftime(o_orderdate, '%Y') >= '1998' THEN o_orderpriority END AS o_orderpriority FROM orders
    """,
)
def allow_field_addition(spark, sf_dir):
    """Later loads bring a column the earlier ones did not have."""
    target = TableSpec(path=scratch(spark, "table"), partition_column="o_orderdate", granularity="MONTH")
    df = normalize_timestamps(orders(spark, sf_dir))
    early = F.date_format("o_orderdate", "yyyy") < "1998"
    overwrite_partition_range(df.filter(early).drop("o_orderpriority"), target)
    overwrite_partition_range(df.filter(~early), target)
    return read_table(spark, target.path).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query(
    "allow_field_relaxation",
    """
    SELECT o_orderkey, CASE WHEN strftime(o_orderdate, '%Y') < '1998' THEN o_orderstatus END AS o_orderstatus,
           o_orderpriority FROM orders
    """,
)
def allow_field_relaxation(spark, sf_dir):
    """Later loads lack a column of the table."""
    target = TableSpec(path=scratch(spark, "table"), partition_column="o_orderdate", granularity="MONTH")
    df = normalize_timestamps(orders(spark, sf_dir))
    early = F.date_format("o_orderdate", "yyyy") < "1998"
    overwrite_partition_range(df.filter(early), target)
    overwrite_partition_range(df.filter(~early).drop("o_orderstatus"), target)
    return read_table(spark, target.path).select("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("staged_write", MONTHLY_SQL)
def staged_write(spark, sf_dir):
    root = monthly_orders(spark, sf_dir)
    target = scratch(spark, "table")
    run_load(spark, months_into(target, staging_path=scratch(spark, "staging")), root, "run-1")
    return monthly(read_table(spark, target, with_part_id=True))


@query("convert_format", ORDERS_SQL)
def convert_format_query(spark, sf_dir):
    """CSV to gzipped JSON lines to snappy ORC."""
    first = flat_orders(spark, sf_dir, "csv", compression="bzip2")
    second, third = scratch(spark, "json"), scratch(spark, "orc")
    convert_format(spark, first, "delimited", second, "json", "gzip", delimiter=",", schema=ORDERS_TEXT_SCHEMA)
    convert_format(spark, second, "json", third, "orc", "snappy")
    return order_rows(scan(spark, third, "orc"))


@query(
    "quarantine_sink",
    """
    SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'malformed' ELSE 'missing:name' END AS reason, count(*) AS n
    FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 17 = 0 GROUP BY 1
    """,
)
def quarantine_sink_query(spark, sf_dir):
    """Rejected events, stored twice under one run and so kept once."""
    path = scratch(spark, "quarantine")
    rejects = rejected_records(parse_events(event_texts(spark, sf_dir))).withColumn("run_uuid", F.lit("run-1"))
    for _ in range(2):
        quarantine_sink(rejects, path)
    stored = spark.read.parquet(path)
    return stored.groupBy(F.array_join("reasons", ",").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "load_with_quarantine",
    """
    SELECT CASE WHEN o_orderkey % 10 = 3 THEN 'malformed partition value' ELSE 'loaded' END AS outcome, count(*) AS n
    FROM orders GROUP BY 1
    """,
)
def load_with_quarantine(spark, sf_dir):
    """Files of one folder have no valid month; their rows are set aside."""
    folder = F.when(F.col("o_orderkey") % 10 == 3, F.lit("199813")).otherwise(F.date_format("o_orderdate", "yyyyMM"))
    root = f"{scratch(spark, 'files')}/daily/data"
    rows = orders(spark, sf_dir).withColumn("folder", folder).hint("rebalance", "folder")
    rows.write.partitionBy("folder").csv(root)
    plain_folders(root, spark, "folder")
    target, aside = scratch(spark, "table"), scratch(spark, "quarantine")
    spec = months_into(target, on_error="quarantine", quarantine_path=aside)
    run_load(spark, spec, root, "run-1")
    loaded = read_table(spark, target).select(F.lit("loaded").alias("outcome"))
    rejected = spark.read.parquet(aside).select(F.array_join("reasons", ",").alias("outcome"))
    return loaded.unionByName(rejected).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def with_margin(df, params):
    """A caller's own step between scan and write."""
    return df.withColumn("margin", F.col("o_totalprice") * params["rate"]).filter("o_orderstatus = 'F'")


@query(
    "custom_transform",
    "SELECT o_orderkey, o_totalprice * CAST(0.25 AS DOUBLE) AS margin FROM orders WHERE o_orderstatus = 'F'",
)
def custom_transform(spark, sf_dir):
    root = monthly_orders(spark, sf_dir)
    target = scratch(spark, "table")
    run_load(spark, months_into(target, transform=with_margin, params={"rate": 0.25}), root, "run-1")
    return read_table(spark, target).select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), "margin")


@query(
    "run_audit",
    """
    SELECT 'orders' AS job, 'table' AS mode, 'succeeded' AS status, count(*) AS row_count,
           count(DISTINCT strftime(o_orderdate, '%Y%m')) AS partition_count,
           min(strftime(o_orderdate, '%Y%m')) AS first_partition, max(strftime(o_orderdate, '%Y%m')) AS last_partition,
           CAST(0 AS BIGINT) AS rejected_count
    FROM orders
    """,
)
def run_audit(spark, sf_dir):
    root = monthly_orders(spark, sf_dir)
    audit = run_load(spark, months_into(scratch(spark, "table")), root, "run-1")
    return audit.select(
        "job",
        "mode",
        "status",
        "row_count",
        "partition_count",
        F.array_min("partitions").alias("first_partition"),
        F.array_max("partitions").alias("last_partition"),
        "rejected_count",
    )
