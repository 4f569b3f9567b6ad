"""Section C, events against rules, with D5 and D7."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockline.operators.ledger import changed_since_last, latest_per_key
from dockline.operators.registry import first_match, fk_violations
from dockline.operators.routing import (
    analyze_matches,
    event_disposition,
    lookup_by_name,
    match_counts,
    match_pairs,
    multi_match,
    resolve_single_job,
    route_events,
)

from . import query
from .fixtures import OBJECTS_SQL, RULES_SQL, objects, orders, rules, table
from .predicates import ledger_of_events

KEY = ["o_orderkey"]

PAIRS_SQL = f"""
SELECT o.o_orderkey, o.bucket, o.name, r.job, r.mode, r.ordinal, r.auto_trigger
FROM ({OBJECTS_SQL}) o JOIN {RULES_SQL.replace('AS rules(', 'AS r(')}
  ON o.bucket = r.source_bucket AND regexp_matches(o.name, r.source_prefix)
"""


@query("route_events", f"SELECT o_orderkey, job, mode, ordinal FROM ({PAIRS_SQL}) WHERE auto_trigger")
def route_events_query(spark, sf_dir):
    routed = route_events(objects(spark, sf_dir), rules(spark))
    return routed.select("o_orderkey", "job", "mode", F.col("ordinal").cast("int").alias("ordinal"))


USER_OBJECTS_SQL = """
SELECT event_id, 'b' || (user_id % 7) AS bucket,
       'u' || user_id || '/' || event_type || '/' || strftime(ts, '%Y%m%d') || '/part-' || (event_id % 4) || '.json' AS name
FROM events
"""
USER_RULES_SQL = """
SELECT DISTINCT 'u' || user_id || '-' || event_type AS job, 'b' || (user_id % 7) AS source_bucket,
       '^u' || user_id || '/' || event_type || '/\\d{8}/part-[0-2]' AS source_prefix
FROM events
"""


def user_objects(spark, sf_dir):
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    bucket = F.concat(F.lit("b"), (F.col("user_id") % 7).cast("string"))
    return table(spark, sf_dir, "events").select(
        "event_id",
        bucket.alias("bucket"),
        F.concat(
            F.lit("u"), user, F.lit("/"), kind, F.lit("/"), F.date_format("ts", "yyyyMMdd"),
            F.lit("/part-"), (F.col("event_id") % 4).cast("string"), F.lit(".json"),
        ).alias("name"),
    )


def user_rules(spark, sf_dir):
    """A registry that grows with the data: one rule per user and event type."""
    user, kind = F.col("user_id").cast("string"), F.col("event_type")
    return (
        table(spark, sf_dir, "events")
        .select("user_id", "event_type")
        .distinct()
        .select(
            F.concat(F.lit("u"), user, F.lit("-"), kind).alias("name"),
            F.concat(F.lit("b"), (F.col("user_id") % 7).cast("string")).alias("source_bucket"),
            F.concat(F.lit("^u"), user, F.lit("/"), kind, F.lit(r"/\d{8}/part-[0-2]")).alias("source_prefix"),
            F.lit("file").alias("mode"),
            F.lit(True).alias("auto_trigger"),
            F.lit(0).cast("bigint").alias("ordinal"),
        )
    )


@query(
    "route_events_many_rules",
    f"""
    SELECT e.event_id, r.job FROM ({USER_OBJECTS_SQL}) e JOIN ({USER_RULES_SQL}) r
      ON e.bucket = r.source_bucket AND starts_with(e.name, split_part(substr(r.source_prefix, 2), '\\', 1))
     AND regexp_matches(e.name, r.source_prefix)
    """,
)
def route_events_many_rules(spark, sf_dir):
    pairs = match_pairs(user_objects(spark, sf_dir), user_rules(spark, sf_dir))
    return pairs.select("event_id", F.col("rule.name").alias("job"))


LOOSE_RULES_SQL = f"SELECT job, source_bucket, substr(source_prefix, 2) AS source_prefix FROM ({USER_RULES_SQL})"


@query(
    "route_events_without_folder",
    f"""
    SELECT e.event_id, r.job FROM ({USER_OBJECTS_SQL}) e JOIN ({LOOSE_RULES_SQL}) r
      ON e.bucket = r.source_bucket AND contains(e.name, split_part(r.source_prefix, '\\', 1))
     AND regexp_matches(e.name, r.source_prefix)
    """,
)
def route_events_without_folder(spark, sf_dir):
    """The same registry with patterns that may match anywhere in a name."""
    loose = user_rules(spark, sf_dir).withColumn("source_prefix", F.expr("substr(source_prefix, 2)"))
    pairs = match_pairs(user_objects(spark, sf_dir), loose)
    return pairs.select("event_id", F.col("rule.name").alias("job"))


@query(
    "route_events_with_manifest",
    f"""
    WITH o AS ({OBJECTS_SQL}),
    e AS (SELECT * FROM o UNION ALL SELECT o_orderkey, bucket, regexp_replace(name, 'part-.*', '') AS name FROM o),
    folders AS (
      SELECT DISTINCT bucket, regexp_replace(name, 'part-.*', '') AS name FROM o
      WHERE bucket <> 'b2' OR name NOT LIKE '%part-3.csv')
    SELECT e.o_orderkey, r.job FROM e JOIN {RULES_SQL.replace('AS rules(', 'AS r(')}
      ON e.bucket = r.source_bucket AND regexp_matches(e.name, r.source_prefix)
    WHERE r.auto_trigger AND (r.mode <> 'folder' OR (e.bucket, e.name) IN (SELECT bucket, name FROM folders))
    """,
)
def route_events_with_manifest(spark, sf_dir):
    """File events of all objects and folder events of all buckets; some folders do not exist."""
    found = objects(spark, sf_dir)
    folders = found.withColumn("name", F.regexp_replace("name", "part-.*", ""))
    manifest = found.filter((F.col("bucket") != "b2") | ~F.col("name").like("%part-3.csv"))
    return route_events(found.unionByName(folders), rules(spark), manifest).select("o_orderkey", "job")


@query(
    "resolve_single_job",
    f"""
    SELECT o.o_orderkey, CASE WHEN count(p.job) = 1 THEN min(p.job) END AS job,
           CASE WHEN count(p.job) = 0 THEN 'not found' WHEN count(p.job) > 1 THEN 'multiple matches' END AS error
    FROM orders o LEFT JOIN ({PAIRS_SQL}) p USING (o_orderkey) GROUP BY 1
    """,
)
def resolve_single_job_query(spark, sf_dir):
    return resolve_single_job(objects(spark, sf_dir), rules(spark), KEY).select("o_orderkey", "job", "error")


@query(
    "analyze_matches",
    f"""
    SELECT o.o_orderkey,
           coalesce(string_agg(CASE WHEN p.auto_trigger THEN p.job END, ',' ORDER BY p.ordinal), '') AS will_run,
           coalesce(string_agg(CASE WHEN NOT p.auto_trigger THEN p.job END, ',' ORDER BY p.ordinal), '') AS ignored,
           2 - count(p.job) AS n_pattern_mismatch, 4 AS n_bucket_mismatch
    FROM ({OBJECTS_SQL}) o LEFT JOIN ({PAIRS_SQL}) p ON o.o_orderkey = p.o_orderkey GROUP BY 1
    """,
)
def analyze_matches_query(spark, sf_dir):
    return analyze_matches(objects(spark, sf_dir), rules(spark), KEY).select(
        "o_orderkey",
        F.array_join("will_run", ",").alias("will_run"),
        F.array_join("ignored", ",").alias("ignored"),
        "n_pattern_mismatch",
        F.col("n_bucket_mismatch").cast("int").alias("n_bucket_mismatch"),
    )


@query(
    "match_counts",
    f"""
    WITH p AS ({PAIRS_SQL})
    SELECT 'will_run' AS class, (SELECT count(*) FROM p WHERE auto_trigger) AS n
    UNION ALL SELECT 'ignored', (SELECT count(*) FROM p WHERE NOT auto_trigger)
    UNION ALL SELECT 'no_match', (SELECT count(*) FROM orders) * 6 - (SELECT count(*) FROM p)
    """,
)
def match_counts_query(spark, sf_dir):
    return match_counts(analyze_matches(objects(spark, sf_dir), rules(spark), KEY))


@query(
    "multi_match",
    f"""
    SELECT o_orderkey, string_agg(job, ',' ORDER BY ordinal) AS jobs FROM ({PAIRS_SQL})
    WHERE auto_trigger GROUP BY 1 HAVING count(*) > 1
    """,
)
def multi_match_query(spark, sf_dir):
    found = multi_match(objects(spark, sf_dir), rules(spark), KEY)
    return found.select("o_orderkey", F.array_join("jobs", ",").alias("jobs"))


@query(
    "event_disposition",
    f"""
    SELECT o.o_orderkey, CASE WHEN count(p.job) > 0 THEN 'accepted' ELSE 'ignored' END AS status
    FROM orders o LEFT JOIN (SELECT * FROM ({PAIRS_SQL}) WHERE auto_trigger) p USING (o_orderkey) GROUP BY 1
    """,
)
def event_disposition_query(spark, sf_dir):
    return event_disposition(objects(spark, sf_dir), rules(spark), KEY).select("o_orderkey", "status")


FOLDER_CHECKED_SQL = f"""
SELECT e.o_orderkey, e.is_folder, r.job, r.auto_trigger
FROM (SELECT o_orderkey, false AS is_folder, bucket, name FROM ({OBJECTS_SQL})
      UNION ALL SELECT o_orderkey, true, bucket, regexp_replace(name, 'part-.*', '') FROM ({OBJECTS_SQL})) e
JOIN {RULES_SQL.replace('AS rules(', 'AS r(')} ON e.bucket = r.source_bucket AND regexp_matches(e.name, r.source_prefix)
LEFT JOIN (SELECT DISTINCT bucket, regexp_replace(name, 'part-.*', '') AS name FROM ({OBJECTS_SQL})
           WHERE name NOT LIKE '%part-3.csv') f ON f.bucket = e.bucket AND f.name = e.name
WHERE r.mode <> 'folder' OR f.name IS NOT NULL
"""
EVENT_KEYS_SQL = "SELECT o_orderkey, is_folder FROM orders, (VALUES (false), (true)) AS k(is_folder)"


def folder_checked(spark, sf_dir):
    """Events of all objects and of their folders, and a listing that lacks some of both."""
    found = objects(spark, sf_dir).withColumn("is_folder", F.lit(False))
    folders = found.withColumns({"name": F.regexp_replace("name", "part-.*", ""), "is_folder": F.lit(True)})
    listing = objects(spark, sf_dir).filter(~F.col("name").like("%part-3.csv"))
    return found.unionByName(folders), listing


@query(
    "event_disposition_with_manifest",
    f"""
    SELECT k.o_orderkey, k.is_folder, CASE WHEN count(p.job) > 0 THEN 'accepted' ELSE 'ignored' END AS status
    FROM ({EVENT_KEYS_SQL}) k LEFT JOIN (SELECT * FROM ({FOLDER_CHECKED_SQL}) WHERE auto_trigger) p USING (o_orderkey, is_folder)
    GROUP BY 1, 2
    """,
)
def event_disposition_with_manifest(spark, sf_dir):
    events, listing = folder_checked(spark, sf_dir)
    found = event_disposition(events, rules(spark), ["o_orderkey", "is_folder"], listing)
    return found.select("o_orderkey", "is_folder", "status")


@query(
    "resolve_single_job_with_manifest",
    f"""
    SELECT k.o_orderkey, k.is_folder, CASE WHEN count(p.job) = 1 THEN min(p.job) END AS job,
           CASE WHEN count(p.job) = 0 THEN 'not found' WHEN count(p.job) > 1 THEN 'multiple matches' END AS error
    FROM ({EVENT_KEYS_SQL}) k LEFT JOIN ({FOLDER_CHECKED_SQL}) p USING (o_orderkey, is_folder) GROUP BY 1, 2
    """,
)
def resolve_single_job_with_manifest(spark, sf_dir):
    events, listing = folder_checked(spark, sf_dir)
    found = resolve_single_job(events, rules(spark), ["o_orderkey", "is_folder"], listing)
    return found.select("o_orderkey", "is_folder", "job", "error")


@query(
    "resolve_repeated_keys",
    f"""
    SELECT e.event_id, count(r.job) AS n_matches, CASE WHEN count(r.job) = 1 THEN min(r.job) END AS job
    FROM ({USER_OBJECTS_SQL}) e LEFT JOIN ({USER_RULES_SQL}) r
      ON e.bucket = r.source_bucket AND starts_with(e.name, split_part(substr(r.source_prefix, 2), '\\', 1))
     AND regexp_matches(e.name, r.source_prefix)
    GROUP BY 1
    """,
)
def resolve_repeated_keys(spark, sf_dir):
    """Many rules, and event keys that repeat and are null."""
    events = user_objects(spark, sf_dir).withColumn("key", F.nullif(F.col("event_id") % 3, F.lit(0)))
    found = resolve_single_job(events, user_rules(spark, sf_dir), ["key"])
    return found.select("event_id", F.col("n_matches").cast("bigint").alias("n_matches"), "job")


@query(
    "lookup_by_name",
    """
    SELECT o_orderkey, s_name, s_name IS NOT NULL AS found
    FROM orders LEFT JOIN supplier ON o_custkey = s_suppkey
    """,
)
def lookup_by_name_query(spark, sf_dir):
    """Customers that are suppliers, by key; most orders name one that is not."""
    registry = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("name"), "s_name")
    wanted = orders(spark, sf_dir).select("o_orderkey", F.col("o_custkey").alias("name"))
    return lookup_by_name(wanted, registry).select("o_orderkey", "s_name", "found")


@query(
    "fk_violations",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)",
)
def fk_violations_query(spark, sf_dir):
    parent = table(spark, sf_dir, "supplier")
    return fk_violations(orders(spark, sf_dir), parent, {"o_custkey": "s_suppkey"}).select("o_orderkey", "o_custkey")


@query(
    "first_match",
    f"SELECT o_orderkey, arg_min(job, ordinal) AS job FROM ({PAIRS_SQL}) GROUP BY 1",
)
def first_match_query(spark, sf_dir):
    pairs = match_pairs(objects(spark, sf_dir), rules(spark)).select(
        "o_orderkey", F.col("rule.name").alias("job"), F.col("rule.ordinal").alias("ordinal")
    )
    return first_match(pairs, KEY, "ordinal", ["job"])


@query(
    "content_changed",
    """
    WITH last AS (SELECT user_id, arg_max(event_type, ts) AS h, max(ts) AS t FROM events GROUP BY 1)
    SELECT e.event_id, CASE WHEN e.event_id % 3 = 0 THEN e.ts <> l.t ELSE e.event_type <> l.h END AS changed
    FROM events e JOIN last l USING (user_id)
    """,
)
def content_changed_query(spark, sf_dir):
    """Each event against its user's newest one; two thirds carry no uid."""
    events = table(spark, sf_dir, "events").withColumn("uid", F.unix_micros(F.col("ts").cast("timestamp")).cast("string"))
    newest = latest_per_key(ledger_of_events(spark, sf_dir)).withColumn(
        "event_uid", F.unix_micros("created_at").cast("string")
    )
    now = events.select(
        "event_id",
        F.col("user_id").cast("string").alias("task_key"),
        F.when(F.col("event_id") % 3 == 0, F.col("uid")).alias("event_uid"),
        F.when(F.col("event_id") % 3 != 0, F.col("event_type")).alias("content_hash"),
    )
    return changed_since_last(now, newest).select("event_id", "changed")
