"""Section A: reading files."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockline.functions.paths import last_segment
from dockline.options import parse_separator
from dockline.session import scratch
from dockline.sinks.storage import Folder
from dockline.sources.events import parse_events, rejected_records, valid_events
from dockline.sources.manifest import expand_folders, expand_wildcard, object_manifest
from dockline.sources.scan import normalize_timestamps, scan, source_path

from . import query
from .fixtures import (
    CENTS_SQL,
    OBJECTS_SQL,
    ORDERS_SQL,
    ORDERS_TEXT_SCHEMA,
    cents,
    dated_files,
    flat_orders,
    monthly_orders,
    objects,
    order_rows,
    orders,
    strip_extensions,
    table,
)


@query("scan_parquet", ORDERS_SQL)
def scan_parquet(spark, sf_dir):
    return order_rows(scan(spark, f"{sf_dir}/orders.parquet", "parquet"))


@query("scan_orc", ORDERS_SQL)
def scan_orc(spark, sf_dir):
    return order_rows(scan(spark, flat_orders(spark, sf_dir, "orc"), "orc"))


@query("scan_json", ORDERS_SQL)
def scan_json(spark, sf_dir):
    return order_rows(scan(spark, flat_orders(spark, sf_dir, "json"), "json"))


@query("scan_delimited", ORDERS_SQL)
def scan_delimited(spark, sf_dir):
    files = flat_orders(spark, sf_dir, "csv", sep="|", header="true")
    return order_rows(scan(spark, files, "delimited", delimiter="|", has_header=True, schema=ORDERS_TEXT_SCHEMA))


@query("scan_delimited_schema", ORDERS_SQL)
def scan_delimited_schema(spark, sf_dir):
    files = flat_orders(spark, sf_dir, "csv")
    return order_rows(scan(spark, files, "delimited", delimiter=",", schema=ORDERS_TEXT_SCHEMA))


@query("scan_delimited_inferred", ORDERS_SQL)
def scan_delimited_inferred(spark, sf_dir):
    files = flat_orders(spark, sf_dir, "csv", sep="|", header="true")
    return order_rows(scan(spark, files, "delimited", delimiter="|", has_header=True))


@query("scan_delimited_ctrl_sep", ORDERS_SQL)
def scan_delimited_ctrl_sep(spark, sf_dir):
    files = flat_orders(spark, sf_dir, "csv", sep=parse_separator("u+0001"))
    return order_rows(scan(spark, files, "delimited", delimiter="u+0001", schema=ORDERS_TEXT_SCHEMA))


@query(
    "scan_compressed",
    f"SELECT c.codec, o.* FROM ({ORDERS_SQL}) o CROSS JOIN (VALUES ('gzip'), ('bzip2'), ('snappy')) AS c(codec)",
)
def scan_compressed(spark, sf_dir):
    """Each codec with its usual file extension."""
    parts = []
    for codec in ("gzip", "bzip2", "snappy"):
        files = flat_orders(spark, sf_dir, "csv", compression=codec)
        df = scan(spark, files, "delimited", delimiter=",", schema=ORDERS_TEXT_SCHEMA)
        parts.append(order_rows(df).withColumn("codec", F.lit(codec)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "scan_compressed_without_extension",
    f"SELECT c.codec, o.* FROM ({ORDERS_SQL}) o CROSS JOIN (VALUES ('gzip'), ('bzip2'), ('snappy')) AS c(codec)",
)
def scan_compressed_without_extension(spark, sf_dir):
    parts = []
    for codec in ("gzip", "bzip2", "snappy"):
        files = strip_extensions(spark, flat_orders(spark, sf_dir, "csv", compression=codec, header="true"))
        df = scan(
            spark, files, "delimited", delimiter=",", has_header=True, schema=ORDERS_TEXT_SCHEMA, codec=codec
        )
        parts.append(order_rows(df).withColumn("codec", F.lit(codec)))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("scan_compressed_json", ORDERS_SQL)
def scan_compressed_json(spark, sf_dir):
    files = strip_extensions(spark, flat_orders(spark, sf_dir, "json", compression="gzip"))
    return order_rows(scan(spark, files, "json", codec="gzip"))


@query("scan_single_path", ORDERS_SQL)
def scan_single_path(spark, sf_dir):
    files = flat_orders(spark, sf_dir, "parquet")
    return order_rows(scan(spark, files, "parquet"))


@query("scan_multi_path", ORDERS_SQL)
def scan_multi_path(spark, sf_dir):
    """All monthly folders as one list of paths, read by one scan."""
    root = monthly_orders(spark, sf_dir)
    paths = [f"{root}/{month}" for month in Folder(spark, root).children()]
    return order_rows(scan(spark, paths, "delimited", delimiter=",", schema=ORDERS_TEXT_SCHEMA))


@query("scan_partitioned_folder", ORDERS_SQL)
def scan_partitioned_folder(spark, sf_dir):
    root = monthly_orders(spark, sf_dir, "parquet")
    return order_rows(normalize_timestamps(scan(spark, root, "parquet", recursive=True)))


@query(
    "scan_key_value_folder",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS ym FROM orders",
)
def scan_key_value_folder(spark, sf_dir):
    root = scratch(spark, "files")
    rows = orders(spark, sf_dir).withColumn("ym", F.date_format("o_orderdate", "yyyyMM")).hint("rebalance", "ym")
    rows.write.partitionBy("ym").parquet(root)
    return scan(spark, root, "parquet").select("o_orderkey", F.col("ym").cast("string").alias("ym"))


@query(
    "expand_wildcard",
    f"""
    SELECT DISTINCT 'daily/data/' || split_part(name, '/', 3) AS path
    FROM ({OBJECTS_SQL}) WHERE name GLOB 'daily/data/1998*/*' ORDER BY path
    """,
)
def expand_wildcard_query(spark, sf_dir):
    return expand_wildcard(objects(spark, sf_dir), "daily/data/1998*")


@query(
    "scan_wildcard",
    f"""
    SELECT strftime(o_orderdate, '%Y%m') AS month, count(*) AS n, {CENTS_SQL.format('o_totalprice')} AS total
    FROM orders WHERE strftime(o_orderdate, '%Y%m') GLOB '199[78]0?' GROUP BY 1
    """,
)
def scan_wildcard(spark, sf_dir):
    """List, expand the pattern, read the matching folders in one scan."""
    root = monthly_orders(spark, sf_dir)
    paths = expand_folders(spark, f"{root}/199[78]0?")
    df = scan(spark, paths, "delimited", delimiter=",", schema=ORDERS_TEXT_SCHEMA, lineage=True)
    month = F.regexp_extract(source_path(), r"/daily/data/(\d{6})/", 1)
    return df.groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("n"), cents("o_totalprice").alias("total"))


@query(
    "file_lineage",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y%m') AS folder FROM orders",
)
def file_lineage(spark, sf_dir):
    root = monthly_orders(spark, sf_dir, "parquet")
    df = scan(spark, root, "parquet", recursive=True, lineage=True)
    return df.select("o_orderkey", last_segment(F.regexp_replace(source_path(), "/[^/]*$", "")).alias("folder"))


def event_texts(spark, sf_dir):
    """Object events as JSON: every 11th lacks its name, every 13th has a key too many."""
    key = F.col("o_orderkey")
    text = F.to_json(
        F.struct(
            "bucket",
            F.when(key % 11 != 0, F.col("name")).alias("name"),
            F.when(key % 5 != 0, key.cast("string")).alias("generation"),
            F.when(key % 13 == 0, F.lit("x")).alias("surplus"),
        )
    )
    # Every 17th is cut short and no longer JSON.
    return objects(spark, sf_dir).select(F.when(key % 17 == 0, F.lit('{"bucket": ')).otherwise(text).alias("value"))


@query(
    "parse_events",
    f"""
    SELECT bucket, name, CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS generation,
           FALSE AS force_run
    FROM ({OBJECTS_SQL}) WHERE o_orderkey % 11 <> 0 AND o_orderkey % 17 <> 0
    """,
)
def parse_events_query(spark, sf_dir):
    return valid_events(parse_events(event_texts(spark, sf_dir))).select("bucket", "name", "generation", "force_run")


@query(
    "parse_events_rejected",
    f"""
    SELECT CASE WHEN o_orderkey % 17 = 0 THEN 'malformed' ELSE 'missing:name' END AS reason, count(*) AS n
    FROM ({OBJECTS_SQL}) WHERE o_orderkey % 11 = 0 OR o_orderkey % 17 = 0 GROUP BY 1
    """,
)
def parse_events_rejected(spark, sf_dir):
    rejected = rejected_records(parse_events(event_texts(spark, sf_dir)))
    return rejected.groupBy(F.array_join("reasons", ",").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "object_manifest",
    "SELECT DISTINCT strftime(ts, '%Y%m%d') AS folder, TRUE AS has_bytes FROM events",
)
def object_manifest_query(spark, sf_dir):
    root = dated_files(table(spark, sf_dir, "events"), "ts", "yyyyMMdd", "parquet")
    listing = object_manifest(spark, root, "b")
    return listing.groupBy(F.split("name", "/")[0].alias("folder")).agg((F.sum("size") > 0).alias("has_bytes"))
