"""C6, C9 and F3: what paths are and what a request loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from dockline.functions.paths import strip_filename
from dockline.operators.classify import classify_paths, resolve_input_path
from dockline.operators.registry import path_set, sorted_paths

from . import query
from .fixtures import OBJECTS_SQL, objects, spread

# Every object, its folder, the folder with a slash, a missing sibling, the root,
# a folder above, and a text that is only the beginning of a folder's name.
PROBES_SQL = f"""
SELECT o_orderkey, bucket, unnest([name, rtrim(regexp_replace(name, '[^/]*$', ''), '/'), regexp_replace(name, '[^/]*$', ''),
    name || '.missing', '', 'daily/', 'daily/dat']) AS path FROM ({OBJECTS_SQL})
"""


def probes(spark, sf_dir):
    name = F.col("name")
    folder = strip_filename(name)
    paths = F.array(
        name,
        F.rtrim(folder, F.lit("/")),
        folder,
        F.concat(name, F.lit(".missing")),
        F.lit(""),
        F.lit("daily/"),
        F.lit("daily/dat"),
    )
    return spread(objects(spark, sf_dir), "o_orderkey").select("o_orderkey", "bucket", F.explode(paths).alias("path"))


CLASSES_SQL = f"""
WITH objects AS ({OBJECTS_SQL}),
     probes AS ({PROBES_SQL}),
     folders AS (SELECT DISTINCT bucket, 'daily' AS path FROM objects UNION SELECT DISTINCT bucket, 'daily/data' FROM objects
                 UNION SELECT DISTINCT bucket, 'daily/data/' || split_part(name, '/', 3) FROM objects),
     files AS (SELECT DISTINCT bucket, name AS path FROM objects)
SELECT p.o_orderkey, p.bucket, p.path,
       CASE WHEN trim(p.path, '/') = '' THEN 'folder' WHEN f.path IS NOT NULL THEN 'file'
            WHEN d.path IS NOT NULL THEN 'folder' ELSE 'not_found' END AS path_class
FROM probes p LEFT JOIN files f ON f.bucket = p.bucket AND f.path = trim(p.path, '/')
LEFT JOIN folders d ON d.bucket = p.bucket AND d.path = trim(p.path, '/')
"""


@query("classify_path", CLASSES_SQL)
def classify_path(spark, sf_dir):
    return classify_paths(probes(spark, sf_dir), objects(spark, sf_dir))


@query(
    "resolve_input_path",
    f"""
    SELECT o_orderkey, path AS name, mode,
           CASE WHEN error IS NULL THEN CASE WHEN mode <> 'marker' THEN path WHEN ends_with(path, '/') THEN path
                ELSE regexp_replace(path, '[^/]*$', '') END END AS input_path, error
    FROM (SELECT *, CASE WHEN contains(path, '*') OR contains(path, '?') THEN NULL
                         WHEN path_class = 'not_found' THEN 'path not found'
                         WHEN mode = 'folder' AND path_class <> 'folder' THEN 'not a folder'
                         WHEN mode <> 'folder' AND path_class = 'folder' THEN 'is a folder' END AS error
          FROM (SELECT *, ['file', 'folder', 'marker'][1 + o_orderkey % 3] AS mode FROM ({CLASSES_SQL})))
    """,
)
def resolve_input_path_query(spark, sf_dir):
    mode = F.element_at(F.array(F.lit("file"), F.lit("folder"), F.lit("marker")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    requests = probes(spark, sf_dir).withColumnRenamed("path", "name").withColumn("mode", mode)
    resolved = resolve_input_path(requests, objects(spark, sf_dir))
    return resolved.select("o_orderkey", "name", "mode", "input_path", "error")


@query("path_set", f"SELECT DISTINCT bucket || '/' || name AS path FROM ({OBJECTS_SQL})")
def path_set_query(spark, sf_dir):
    return path_set(objects(spark, sf_dir), F.concat_ws("/", "bucket", "name"))


@query("sorted_paths", f"SELECT DISTINCT name AS path FROM ({OBJECTS_SQL}) ORDER BY path")
def sorted_paths_query(spark, sf_dir):
    return sorted_paths(objects(spark, sf_dir), "name")
