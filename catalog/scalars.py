"""Section G: column functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockline.functions import durations, hashing, paths, text
from dockline.functions.partitions import extract_partition, parse_partition_value, partition_name

from . import query
from .fixtures import OBJECTS_SQL, naive, objects, orders, table


@query("extract_partition", f"SELECT o_orderkey, split_part(name, '/', 3) AS part FROM ({OBJECTS_SQL})")
def extract_partition_query(spark, sf_dir):
    part = extract_partition(F.col("name"), r"(?P<day>\d{8})(?=/|$)")
    return objects(spark, sf_dir).select("o_orderkey", part.alias("part"))


@query(
    "parse_partition_value",
    "SELECT o_orderkey, date_trunc('day', o_orderdate) AS value FROM orders",
)
def parse_partition_value_query(spark, sf_dir):
    written = F.concat(F.date_format("o_orderdate", "yyyy-MM"), F.lit("T"), F.date_format("o_orderdate", "dd.HH"))
    value = parse_partition_value(written, "%Y-%mT%d.%H")
    return orders(spark, sf_dir).select("o_orderkey", naive(value).alias("value"))


@query(
    "partition_decorator",
    """
    SELECT event_id, strftime(ts, '%Y%m%d%H') AS hour, strftime(ts, '%Y%m%d') AS day,
           strftime(ts, '%Y%m') AS month, strftime(ts, '%Y') AS year FROM events
    """,
)
def partition_decorator(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id",
        *(partition_name(F.col("ts"), g).alias(g.lower()) for g in ("HOUR", "DAY", "MONTH", "YEAR")),
    )


@query(
    "name_uuid",
    f"""
    SELECT o_orderkey, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4)
           || '-' || substr(h, 21) AS uuid
    FROM (SELECT o_orderkey, md5(name) AS h FROM ({OBJECTS_SQL}))
    """,
)
def name_uuid(spark, sf_dir):
    return objects(spark, sf_dir).select("o_orderkey", hashing.name_uuid(F.col("name")).alias("uuid"))


FINGERPRINT_SQL = f"""
SELECT o_orderkey, bucket, regexp_replace(name, '[^/]*$', '') AS prefix, ['marker', 'file', 'folder'][1 + o_orderkey % 3] AS mode,
       CASE WHEN o_orderkey % 4 <> 0 THEN name ELSE '' END AS file_name,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS generation,
       CASE WHEN o_orderkey % 6 = 0 THEN md5(name) END AS md5_hash,
       CASE WHEN o_orderkey % 11 = 0 THEN '' WHEN o_orderkey % 10 = 0 THEN 'crc' END AS crc32c,
       CASE WHEN o_orderkey % 8 = 0 THEN 'hint' WHEN o_orderkey % 9 = 0 THEN '' END AS manual_hint
FROM ({OBJECTS_SQL})
"""


def fingerprints(spark, sf_dir):
    key = F.col("o_orderkey")
    mode = F.element_at(F.array(F.lit("marker"), F.lit("file"), F.lit("folder")), (key % 3 + 1).cast("int"))
    return objects(spark, sf_dir).select(
        "o_orderkey",
        "bucket",
        paths.strip_filename(F.col("name")).alias("prefix"),
        mode.alias("mode"),
        F.when(key % 4 != 0, F.col("name")).otherwise("").alias("file_name"),
        F.when(key % 5 == 0, None).when(key % 7 == 0, "").otherwise(key.cast("string")).alias("generation"),
        F.when(key % 6 == 0, F.md5("name")).alias("md5_hash"),
        F.when(key % 11 == 0, "").when(key % 10 == 0, "crc").alias("crc32c"),
        F.when(key % 8 == 0, "hint").when(key % 9 == 0, "").alias("manual_hint"),
    )


@query(
    "content_hash",
    f"""
    SELECT o_orderkey, sha256(
      bucket || '::' || prefix || CASE mode
        WHEN 'marker' THEN '::' || coalesce(nullif(file_name, ''), '_UNKNOWN_MARKER') || '::' || coalesce(generation, '')
                           || CASE WHEN coalesce(manual_hint, '') <> '' THEN '::' || manual_hint ELSE '' END
        WHEN 'file' THEN '::' || coalesce(nullif(file_name, ''), '_UNKNOWN_FILE') || '::'
                         || coalesce(nullif(md5_hash, ''), nullif(crc32c, ''), nullif(generation, ''), nullif(manual_hint, ''), '_NO_HASH')
        ELSE CASE WHEN coalesce(manual_hint, '') <> '' THEN '::' || manual_hint ELSE '' END END) AS content_hash
    FROM ({FINGERPRINT_SQL})
    """,
)
def content_hash(spark, sf_dir):
    names = ("mode", "bucket", "prefix", "file_name", "generation", "md5_hash", "crc32c", "manual_hint")
    digest = hashing.content_hash(*(F.col(n) for n in names))
    return fingerprints(spark, sf_dir).select("o_orderkey", digest.alias("content_hash"))


@query(
    "first_non_empty",
    f"""
    SELECT o_orderkey, coalesce(nullif(md5_hash, ''), nullif(crc32c, ''), nullif(generation, ''), nullif(manual_hint, '')) AS value
    FROM ({FINGERPRINT_SQL})
    """,
)
def first_non_empty(spark, sf_dir):
    value = hashing.first_non_empty(*(F.col(n) for n in ("md5_hash", "crc32c", "generation", "manual_hint")))
    return fingerprints(spark, sf_dir).select("o_orderkey", value.alias("value"))


@query(
    "strip_filename",
    f"""
    SELECT o_orderkey, regexp_replace(name, '[^/]*$', '') AS folder, regexp_replace(name, '[^/]*$', '') AS same, '/' AS bare
    FROM ({OBJECTS_SQL})
    """,
)
def strip_filename(spark, sf_dir):
    folder = paths.strip_filename(F.col("name"))
    return objects(spark, sf_dir).select(
        "o_orderkey",
        folder.alias("folder"),
        paths.strip_filename(folder).alias("same"),
        paths.strip_filename(paths.last_segment(F.col("name"))).alias("bare"),
    )


@query("trim_slashes", "SELECT page_id, trim(substr(url, 6), '/') AS path FROM pages")
def trim_slashes(spark, sf_dir):
    tail = F.substring("url", 6, 1 << 30)
    return table(spark, sf_dir, "pages").select("page_id", paths.trim_slashes(tail).alias("path"))


@query("task_key_folder", f"SELECT o_orderkey, bucket || '/' || regexp_replace(name, '/[^/]*$', '') AS task_key FROM ({OBJECTS_SQL})")
def task_key_folder(spark, sf_dir):
    key = paths.task_key_folder(F.col("bucket"), F.col("name"))
    return objects(spark, sf_dir).select("o_orderkey", key.alias("task_key"))


@query("task_key_full", f"SELECT o_orderkey, bucket || '/' || name AS task_key FROM ({OBJECTS_SQL})")
def task_key_full(spark, sf_dir):
    key = paths.task_key_full(F.col("bucket"), F.col("name"))
    return objects(spark, sf_dir).select("o_orderkey", key.alias("task_key"))


@query("event_uid", f"SELECT o_orderkey, bucket || '/' || prefix || '/' || generation AS event_uid FROM ({FINGERPRINT_SQL})")
def event_uid(spark, sf_dir):
    uid = paths.event_uid(F.col("bucket"), F.col("prefix"), F.col("generation"))
    return fingerprints(spark, sf_dir).select("o_orderkey", uid.alias("event_uid"))


@query(
    "render_args",
    f"""
    SELECT o_orderkey, '--input_path=gs://' || bucket || '/' || name || '|--format=json|--cost=$1\\2 ' || bucket || bucket
           || '|--literal={{{{ name' AS args
    FROM ({OBJECTS_SQL})
    """,
)
def render_args(spark, sf_dir):
    args = F.array(
        F.lit("--input_path=gs://{{ source_bucket }}/{{source_prefix}}"),
        F.lit("--format=json"),
        F.lit("--cost=$1\\2 {{source_bucket }}{{ source_bucket}}"),
        F.lit("--literal={{ name"),
    )
    filled = text.render_args(args, {"source_bucket": F.col("bucket"), "source_prefix": F.col("name")})
    return objects(spark, sf_dir).select("o_orderkey", F.array_join(filled, "|").alias("args"))


@query(
    "set_arg",
    "SELECT o_orderkey, '--a=1|--run_uuidx|--run_uuid=' || md5(CAST(o_orderkey AS VARCHAR)) AS args FROM orders",
)
def set_arg(spark, sf_dir):
    before = F.array(F.lit("--run_uuid=old"), F.lit("--a=1"), F.lit("--run_uuid="), F.lit("--run_uuidx"))
    after = text.set_arg(before, F.md5(F.col("o_orderkey").cast("string")))
    return orders(spark, sf_dir).select("o_orderkey", F.array_join(after, "|").alias("args"))


@query(
    "date_to_micros",
    "SELECT o_orderkey, epoch_us(date_trunc('day', o_orderdate)) AS micros FROM orders",
)
def date_to_micros(spark, sf_dir):
    micros = durations.date_to_micros(F.date_format("o_orderdate", "yyyyMMdd"))
    return orders(spark, sf_dir).select("o_orderkey", micros.alias("micros"))


@query(
    "iso_duration",
    """
    SELECT event_id, user_id * 86400 + (event_id % 24) * 3600 + (event_id % 60) * 60 + value AS seconds,
           CAST(604800 * user_id AS DOUBLE) AS weeks, TRUE AS month_refused, TRUE AS empty_refused
    FROM events
    """,
)
def iso_duration(spark, sf_dir):
    key = F.col("event_id")
    written = F.concat(
        F.lit("P"), F.col("user_id").cast("string"), F.lit("DT"), (key % 24).cast("string"), F.lit("H"),
        (key % 60).cast("string"), F.lit("M"), F.col("value").cast("string"), F.lit("S"),
    )
    weeks = F.concat(F.lit("P"), F.col("user_id").cast("string"), F.lit("W"))

    def seconds(column):
        return durations.interval_micros(durations.iso_duration(column)).cast("double") / 1e6

    return table(spark, sf_dir, "events").select(
        "event_id",
        seconds(written).alias("seconds"),
        seconds(weeks).alias("weeks"),
        durations.iso_duration(F.concat(F.lit("P1M"), F.lit(""))).isNull().alias("month_refused"),
        durations.iso_duration(F.lit("PT")).isNull().alias("empty_refused"),
    )


@query(
    "iso_duration_format",
    """
    SELECT o_orderkey, 'P' || CASE WHEN s >= 86400 THEN (s // 86400) || 'D' ELSE '' END
           || CASE WHEN s % 86400 > 0 THEN 'T' ELSE '' END
           || CASE WHEN s % 86400 >= 3600 THEN (s % 86400 // 3600) || 'H' ELSE '' END
           || CASE WHEN s % 3600 >= 60 THEN (s % 3600 // 60) || 'M' ELSE '' END
           || CASE WHEN s % 60 > 0 THEN (s % 60) || 'S' ELSE '' END AS text
    FROM (SELECT o_orderkey, o_orderkey * 60 + o_custkey + 1 AS s FROM orders)
    """,
)
def iso_duration_format(spark, sf_dir):
    seconds = F.col("o_orderkey") * 60 + F.col("o_custkey") + 1
    written = durations.format_iso_duration(seconds * 1_000_000)
    return orders(spark, sf_dir).select("o_orderkey", written.alias("text"))


# Full case mapping, as in the languages the jobs are written in: one ß gives two letters.
@query("upper_words", "SELECT doc_id, upper(replace(text, 'ß', 'ss')) AS text FROM documents")
def upper_words(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.upper_words(F.col("text")).alias("text"))


@query(
    "audit_json",
    """
    SELECT o_orderkey, '{"severity":"INFO",' || CASE WHEN o_orderkey % 3 > 0 THEN '"run":"' || o_custkey || '",' ELSE '' END
           || '"rows":' || o_orderkey || '}' AS record FROM orders
    """,
)
def audit_json(spark, sf_dir):
    run = F.when(F.col("o_orderkey") % 3 > 0, F.col("o_custkey").cast("string"))
    record = text.audit_json(severity=F.lit("INFO"), run=run, rows=F.col("o_orderkey"))
    return orders(spark, sf_dir).select("o_orderkey", record.alias("record"))


@query("build_uri", f"SELECT o_orderkey, 'gs://' || bucket || '/' || name AS uri FROM ({OBJECTS_SQL})")
def build_uri(spark, sf_dir):
    return objects(spark, sf_dir).select("o_orderkey", paths.build_uri(F.col("bucket"), F.col("name")).alias("uri"))


@query(
    "split_uri",
    """
    SELECT page_id, split_part(split_part(url, '://', 2), '/', 1) AS bucket,
           substr(split_part(url, '://', 2), length(split_part(split_part(url, '://', 2), '/', 1)) + 2) AS path
    FROM pages
    """,
)
def split_uri(spark, sf_dir):
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", paths.uri_bucket(url).alias("bucket"), paths.uri_path(url).alias("path")
    )


@query("last_segment", f"SELECT o_orderkey, split_part(name, '/', -1) AS segment FROM ({OBJECTS_SQL})")
def last_segment(spark, sf_dir):
    return objects(spark, sf_dir).select("o_orderkey", paths.last_segment(F.col("name")).alias("segment"))


@query("split_fqn", "SELECT c_custkey, c_mktsegment AS dataset, c_name AS name, c_mktsegment || '.' || c_name AS fqn FROM customer")
def split_fqn(spark, sf_dir):
    fqn = paths.join_fqn(F.col("c_mktsegment"), F.col("c_name"))
    parts = paths.split_fqn(F.col("fqn"))
    named = table(spark, sf_dir, "customer").withColumn("fqn", fqn)
    return named.select("c_custkey", parts[0].alias("dataset"), parts[1].alias("name"), "fqn")


@query("epoch_seconds", "SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS seconds FROM events")
def epoch_seconds(spark, sf_dir):
    seconds = durations.epoch_seconds(F.col("ts").cast("timestamp"))
    return table(spark, sf_dir, "events").select("event_id", seconds.alias("seconds"))
