"""Sections D, E3, F and K2: checks, counts and run status."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from dockline.constants import LEDGER_MAX_AGE, MODES
from dockline.functions.durations import to_micros
from dockline.operators.ledger import cleanup_batch
from dockline.operators.registry import check_rules, duplicate_keys, key_intersection, registry_union, union_evolving
from dockline.operators.status import (
    count_expired,
    distinct_partitions,
    failed_nodes,
    partition_summary,
    run_status,
    run_status_flat,
)
from dockline.session import scratch

from . import query
from .fixtures import orders, table
from .predicates import ledger_of_events


@query("row_count", "SELECT count(*) AS row_count FROM lineitem")
def row_count(spark, sf_dir):
    """Counted while the rows are written, without a pass of its own."""
    seen = Observation()
    table(spark, sf_dir, "lineitem").observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(scratch(spark, "rows"))
    return spark.createDataFrame([(seen.get["n"],)], "row_count bigint")


@query("distinct_partitions", "SELECT DISTINCT date_trunc('month', l_shipdate) AS part FROM lineitem")
def distinct_partitions_query(spark, sf_dir):
    month = F.date_trunc("month", F.col("l_shipdate")).cast("timestamp_ntz")
    return distinct_partitions(table(spark, sf_dir, "lineitem").withColumn("part", month), "part")


@query(
    "partition_summary",
    """
    SELECT strftime(l_shipdate, '%Y%m') AS part_id, count(*) AS row_count,
           min(l_shipdate) AS min_value, max(l_shipdate) AS max_value
    FROM lineitem GROUP BY 1
    """,
)
def partition_summary_query(spark, sf_dir):
    return partition_summary(table(spark, sf_dir, "lineitem"), "l_shipdate", "MONTH")


@query("duplicate_keys", "SELECT p_name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicate_keys_query(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "part"), ["p_name"])


def runs(spark, sf_dir):
    """One run per order, its line items as nodes."""
    node = F.struct(
        F.col("l_linenumber").cast("string").alias("step_id"),
        F.col("l_partkey").cast("string").alias("job_id"),
        F.when(F.col("l_returnflag") == "R", "FAILED").otherwise("COMPLETED").alias("state"),
        F.when(F.col("l_returnflag") == "R", F.concat(F.lit("returned "), F.col("l_suppkey").cast("string"))).alias("error"),
    )
    # Line items of one order are few; the group is as wide as an order.
    graphs = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("run")).agg(F.collect_list(node).alias("nodes"))
    state = F.when(F.col("o_orderstatus") == "F", "DONE").otherwise("RUNNING")
    return (
        orders(spark, sf_dir)
        .select(F.col("o_orderkey").alias("run"), state.alias("state"))
        .join(graphs, "run", "left")
        .select("run", "state", F.struct("nodes").alias("graph"))
    )


@query(
    "run_status",
    """
    SELECT o_orderkey AS run, o_orderstatus = 'F' AS is_completed,
           CASE WHEN o_orderstatus = 'F' THEN NOT coalesce(bool_or(l_returnflag = 'R'), FALSE) END AS is_successful
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey, o_orderstatus
    """,
)
def run_status_query(spark, sf_dir):
    return run_status(runs(spark, sf_dir)).select("run", "is_completed", "is_successful")


@query(
    "run_status_flat",
    """
    SELECT o_orderkey AS run, bool_or(o_orderstatus = 'F') AS is_completed,
           CASE WHEN bool_or(o_orderstatus = 'F') THEN NOT coalesce(bool_or(l_returnflag = 'R'), FALSE) END AS is_successful
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
    """,
)
def run_status_flat_query(spark, sf_dir):
    nodes = (
        orders(spark, sf_dir)
        .join(table(spark, sf_dir, "lineitem"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.col("o_orderkey").alias("run"),
            F.when(F.col("o_orderstatus") == "F", "DONE").otherwise("RUNNING").alias("run_state"),
            F.when(F.col("l_returnflag") == "R", "FAILED").otherwise("COMPLETED").alias("state"),
        )
    )
    return run_status_flat(nodes)


@query(
    "failed_nodes",
    """
    SELECT l_orderkey AS run, CAST(l_linenumber AS VARCHAR) AS step_id, CAST(l_partkey AS VARCHAR) AS job_id,
           'FAILED' AS state, 'returned ' || l_suppkey AS error
    FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IN (SELECT o_orderkey FROM orders)
    """,
)
def failed_nodes_query(spark, sf_dir):
    return failed_nodes(runs(spark, sf_dir))


@query(
    "retention_count",
    "SELECT count(*) AS deleted_count FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 2 DAY",
)
def retention_count(spark, sf_dir):
    now = F.lit("2024-01-20 00:00:00").cast("timestamp")
    return count_expired(ledger_of_events(spark, sf_dir), now, to_micros(LEDGER_MAX_AGE))


@query(
    "bounded_batch",
    """
    SELECT CAST(user_id AS VARCHAR) AS task_key, CAST(event_id AS VARCHAR) AS event_uid
    FROM events WHERE ts < TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 2 DAY
    ORDER BY ts, CAST(user_id AS VARCHAR) LIMIT 500
    """,
)
def bounded_batch(spark, sf_dir):
    """The clean-up takes 500 records at a time."""
    now = F.lit("2024-01-20 00:00:00").cast("timestamp")
    return cleanup_batch(ledger_of_events(spark, sf_dir), now).select("task_key", "event_uid")


@query(
    "key_intersection",
    "SELECT o_custkey AS name FROM orders INTERSECT SELECT s_suppkey FROM supplier",
)
def key_intersection_query(spark, sf_dir):
    left = orders(spark, sf_dir).select(F.col("o_custkey").alias("name"))
    right = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("name"))
    return key_intersection(left, right, ["name"])


@query(
    "registry_union",
    """
    SELECT 'customer' AS kind, c_name AS name, c_nationkey AS nation FROM customer
    UNION ALL SELECT 'supplier', s_name, s_nationkey FROM supplier
    """,
)
def registry_union_query(spark, sf_dir):
    common = table(spark, sf_dir, "customer").select(
        F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")
    )
    own = table(spark, sf_dir, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("kind"), F.col("s_name").alias("name")
    )
    return registry_union(common, own)


@query(
    "union_evolving",
    """
    SELECT o_orderkey, o_orderstatus, NULL AS o_orderpriority FROM orders
    UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders
    """,
)
def union_evolving_query(spark, sf_dir):
    df = orders(spark, sf_dir)
    return union_evolving(df.select("o_orderkey", "o_orderstatus"), df.select("o_orderkey", "o_orderpriority"))


@query(
    "check_rules",
    r"""
    WITH rules AS (SELECT p_name AS name, CASE WHEN p_size % 9 > 0 THEN lower(p_type) END AS mode,
                          'c' || (p_partkey % 40) AS cluster,
                          '^' || p_name || CASE p_partkey % 7 WHEN 0 THEN '/(\d{8}' WHEN 1 THEN '/[' ELSE '/(\d{8})' END AS prefix,
                          CASE p_partkey % 5 WHEN 0 THEN 'PT' || p_size || 'M' WHEN 1 THEN p_size || ' minutes'
                               WHEN 2 THEN 'P' || p_size || 'D' WHEN 3 THEN 'PT' END AS delay,
                          p_partkey % 4 = 0 AS has_colour FROM part)
    SELECT name, 'missing:mode' AS finding FROM rules WHERE mode IS NULL
    UNION ALL SELECT name, 'invalid:mode=' || mode FROM rules WHERE mode NOT IN ('file', 'folder', 'marker', 'economy')
    UNION ALL SELECT name, 'invalid:source_prefix=' || prefix FROM rules WHERE TRY(regexp_matches('', prefix)) IS NULL
    UNION ALL SELECT name, 'invalid:schedule_delay=' || delay FROM rules
              WHERE delay IS NOT NULL AND NOT regexp_full_match(delay, 'P\d+D|PT\d+M')
    UNION ALL SELECT name, 'unknown:colour' FROM rules WHERE has_colour
    UNION ALL SELECT name, 'duplicate name' FROM rules GROUP BY name HAVING count(*) > 1
    UNION ALL SELECT name, 'unknown cluster: ' || cluster FROM rules
              WHERE cluster NOT IN (SELECT 'c' || n_nationkey FROM nation)
    """,
)
def check_rules_query(spark, sf_dir):
    """The whole integrity report, with parts standing in for rules."""
    key = F.col("p_partkey")
    size = F.col("p_size").cast("string")
    ending = F.when(key % 7 == 0, r"/(\d{8}").when(key % 7 == 1, "/[").otherwise(r"/(\d{8})")
    delay = (
        F.when(key % 5 == 0, F.concat(F.lit("PT"), size, F.lit("M")))
        .when(key % 5 == 1, F.concat(size, F.lit(" minutes")))
        .when(key % 5 == 2, F.concat(F.lit("P"), size, F.lit("D")))
        .when(key % 5 == 3, "PT")
    )
    registry = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"),
        F.when(F.col("p_size") % 9 > 0, F.lower("p_type")).alias("mode"),
        F.concat(F.lit("c"), (key % 40).cast("string")).alias("cluster_blueprint_name"),
        F.concat(F.lit("^"), "p_name", ending).alias("source_prefix"),
        delay.alias("schedule_delay"),
        F.when(key % 4 == 0, F.col("p_brand")).alias("colour"),
    )
    clusters = table(spark, sf_dir, "nation").select(F.concat(F.lit("c"), F.col("n_nationkey").cast("string")).alias("name"))
    return check_rules(
        registry,
        clusters,
        ["name", "mode"],
        {"mode": [*MODES, "economy"]},
        patterns=["source_prefix"],
        durations=["schedule_delay"],
        known=["name", "mode", "cluster_blueprint_name", "source_prefix", "schedule_delay"],
    )
