"""Section B: projections, filters and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockline.constants import FORMATS
from dockline.functions.paths import has_wildcards
from dockline.functions.partitions import extract_partition, parse_partition_value, partition_from_path
from dockline.operators.ledger import latest_per_key
from dockline.operators.predicates import (
    auto_trigger_filter,
    bucket_filter,
    enum_domain,
    event_source,
    file_name_required,
    glob_filter,
    path_regex_filter,
    recent_window_filter,
)
from dockline.sources.events import EVENT_FIELDS, missing_fields, unexpected_fields
from dockline.sources.scan import add_lineage, drop_lineage, source_path

from . import query
from .fixtures import OBJECTS_SQL, ORDERS_SQL, RULES_SQL, dated_files, naive, objects, order_rows, orders, rules, table


@query(
    "partition_literal",
    "SELECT o_orderkey, TIMESTAMP '1998-06-01 00:00:00' AS date FROM orders",
)
def partition_literal(spark, sf_dir):
    """One partition value from the input path, the same on every row."""
    value = partition_from_path(F.lit("store/daily/199806/"), r"/(\d{6})/", "%Y%m")
    return orders(spark, sf_dir).select("o_orderkey", naive(value).alias("date"))


@query("partition_from_path", "SELECT event_id, date_trunc('day', ts) AS date FROM events")
def partition_from_path_query(spark, sf_dir):
    root = dated_files(table(spark, sf_dir, "events").select("event_id", "ts"), "ts", "yyyyMMdd", "parquet")
    scanned = add_lineage(spark.read.option("recursiveFileLookup", "true").parquet(root))
    value = partition_from_path(source_path(), r"/data/(\d{8})/", "%Y%m%d")
    return scanned.select("event_id", naive(value).alias("date"))


@query(
    "partition_from_path_date",
    f"SELECT o_orderkey, CAST(strptime(split_part(name, '/', 3), '%Y%m%d') AS DATE) AS date FROM ({OBJECTS_SQL})",
)
def partition_from_path_date(spark, sf_dir):
    value = partition_from_path(F.col("name"), r"(\d{8})/", "%Y%m%d", "date")
    return objects(spark, sf_dir).select("o_orderkey", value.alias("date"))


BROKEN_NAMES_SQL = f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN replace(name, 'data/', 'data/x')
                        WHEN o_orderkey % 5 = 0 THEN 'daily/data/19981399/part.csv' ELSE name END AS name
FROM ({OBJECTS_SQL})
"""


def broken_names(spark, sf_dir):
    key, name = F.col("o_orderkey"), F.col("name")
    return objects(spark, sf_dir).select(
        "o_orderkey",
        F.when(key % 7 == 0, F.replace(name, F.lit("data/"), F.lit("data/x")))
        .when(key % 5 == 0, F.lit("daily/data/19981399/part.csv"))
        .otherwise(name)
        .alias("name"),
    )


@query(
    "partition_error_policy",
    f"""
    SELECT CASE WHEN NOT regexp_matches(name, '/(\\d{{8}})/') THEN 'no partition in path'
                WHEN try_strptime(split_part(name, '/', 3), '%Y%m%d') IS NULL THEN 'malformed'
                ELSE 'ok' END AS outcome, count(*) AS n
    FROM ({BROKEN_NAMES_SQL}) GROUP BY 1
    """,
)
def partition_error_policy(spark, sf_dir):
    """What the quarantine policy makes of each path."""
    text = extract_partition(F.col("name"), r"/(\d{8})/")
    value = parse_partition_value(text, "%Y%m%d")
    outcome = F.when(text.isNull(), "no partition in path").when(value.isNull(), "malformed").otherwise("ok")
    return broken_names(spark, sf_dir).groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("drop_lineage", ORDERS_SQL)
def drop_lineage_query(spark, sf_dir):
    return order_rows(drop_lineage(add_lineage(orders(spark, sf_dir))))


@query("path_regex_filter", f"SELECT * FROM ({OBJECTS_SQL}) WHERE regexp_matches(name, '/1998\\d{{4}}/')")
def path_regex_filter_query(spark, sf_dir):
    return path_regex_filter(objects(spark, sf_dir), r"/1998\d{4}/")


@query("bucket_filter", f"SELECT * FROM ({OBJECTS_SQL}) WHERE bucket = 'b1'")
def bucket_filter_query(spark, sf_dir):
    return bucket_filter(objects(spark, sf_dir), "b1")


@query(
    "auto_trigger_filter",
    "SELECT o_orderkey AS job FROM orders WHERE coalesce(CASE WHEN o_custkey % 3 = 0 THEN o_orderstatus = 'F' END, TRUE)",
)
def auto_trigger_filter_query(spark, sf_dir):
    flag = F.when(F.col("o_custkey") % 3 == 0, F.col("o_orderstatus") == "F")
    registry = orders(spark, sf_dir).select(F.col("o_orderkey").alias("job"), flag.alias("auto_trigger"))
    return auto_trigger_filter(registry).select("job")


@query("glob_filter", f"SELECT * FROM ({OBJECTS_SQL}) WHERE name GLOB 'daily/*199[5-8]0?0[!1-3]*-[02].csv'")
def glob_filter_query(spark, sf_dir):
    return glob_filter(objects(spark, sf_dir), "daily/*199[5-8]0?0[!1-3]*-[02].csv")


@query(
    "has_wildcards",
    "SELECT page_id, contains(url, '*') OR contains(url, '?') AS wild FROM pages",
)
def has_wildcards_query(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", has_wildcards(F.col("url")).alias("wild"))


@query(
    "is_manual",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'manual' ELSE 'eventarc' END AS source FROM orders",
)
def is_manual(spark, sf_dir):
    key = F.col("o_orderkey")
    generation = F.when(key % 5 != 0, key.cast("string"))
    return orders(spark, sf_dir).select("o_orderkey", event_source(generation).alias("source"))


def ledger_of_events(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("task_key"),
        F.col("ts").cast("timestamp").alias("created_at"),
        F.col("event_id").cast("string").alias("event_uid"),
        F.col("event_type").alias("content_hash"),
    )


@query(
    "recent_window_filter",
    """
    SELECT CAST(user_id AS VARCHAR) AS task_key, CAST(event_id AS VARCHAR) AS event_uid FROM events
    WHERE ts >= TIMESTAMP '2024-01-20 00:00:00' - INTERVAL 36 HOUR
    """,
)
def recent_window_filter_query(spark, sf_dir):
    now = F.lit("2024-01-20 00:00:00").cast("timestamp")
    window = F.lit(36 * 3600 * 1_000_000)
    return recent_window_filter(ledger_of_events(spark, sf_dir), now, window).select("task_key", "event_uid")


@query(
    "latest_per_key",
    """
    SELECT CAST(user_id AS VARCHAR) AS task_key, CAST(event_id AS VARCHAR) AS event_uid, ts AS created_at FROM (
      SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, CAST(event_id AS VARCHAR) DESC) AS r FROM events
    ) WHERE r = 1
    """,
)
def latest_per_key_query(spark, sf_dir):
    newest = latest_per_key(ledger_of_events(spark, sf_dir), tie=["event_uid"])
    return newest.select("task_key", "event_uid", naive(F.col("created_at")).alias("created_at"))


@query(
    "required_fields",
    f"""
    SELECT o_orderkey,
           concat_ws(',', CASE WHEN o_orderkey % 10 = 0 THEN 'missing:bucket' END,
                          CASE WHEN o_orderkey % 4 = 0 THEN 'missing:name' END) AS reasons
    FROM ({OBJECTS_SQL}) WHERE o_orderkey % 10 = 0 OR o_orderkey % 4 = 0
    """,
)
def required_fields(spark, sf_dir):
    key = F.col("o_orderkey")
    record = F.struct(
        F.when(key % 10 != 0, F.col("bucket")).alias("bucket"), F.when(key % 4 != 0, F.col("name")).alias("name")
    )
    checked = objects(spark, sf_dir).select("o_orderkey", missing_fields(record, ["bucket", "name"]).alias("found"))
    return checked.filter(F.size("found") > 0).select("o_orderkey", F.array_join("found", ",").alias("reasons"))


@query(
    "unexpected_fields",
    f"SELECT o_orderkey, 'color,size' AS keys FROM ({OBJECTS_SQL}) WHERE o_orderkey % 13 = 0",
)
def unexpected_fields_query(spark, sf_dir):
    extra = F.when(F.col("o_orderkey") % 13 == 0, F.lit("1"))
    raw = F.to_json(F.struct("bucket", extra.alias("size"), "name", extra.alias("color")))
    found = unexpected_fields(raw, EVENT_FIELDS)
    return (
        objects(spark, sf_dir)
        .select("o_orderkey", F.array_sort(found).alias("found"))
        .filter(F.size("found") > 0)
        .select("o_orderkey", F.array_join("found", ",").alias("keys"))
    )


@query(
    "enum_domain",
    """
    SELECT doc_id, coalesce(lang IN ('parquet', 'orc', 'avro', 'json', 'delimited') OR source IN ('web', 'code'), FALSE) AS allowed
    FROM documents
    """,
)
def enum_domain_query(spark, sf_dir):
    allowed = enum_domain(F.col("lang"), FORMATS) | enum_domain(F.col("source"), ["web", "code"])
    return table(spark, sf_dir, "documents").select("doc_id", allowed.alias("allowed"))


@query(
    "file_name_required",
    f"""
    SELECT o.o_orderkey, r.job FROM ({OBJECTS_SQL}) o JOIN {RULES_SQL} ON r.source_bucket = o.bucket
    WHERE r.mode IN ('file', 'marker') AND o.o_orderkey % 9 = 0
    """.replace("AS rules(", "AS r("),
)
def file_name_required_query(spark, sf_dir):
    """Events without a name, with each rule of their bucket that needs one."""
    events = objects(spark, sf_dir).withColumn("name", F.when(F.col("o_orderkey") % 9 != 0, F.col("name")).otherwise(""))
    registry = rules(spark).select(F.col("name").alias("job"), F.col("source_bucket").alias("bucket"), "mode")
    # Only nameless events can lack one; the others never meet the rules.
    nameless = events.filter("name IS NULL OR name = ''")
    found = nameless.join(registry, "bucket").withColumn("error", file_name_required(F.col("mode"), F.col("name")))
    return found.filter("error IS NOT NULL").select("o_orderkey", "job")
