"""Object listings as tables, and wildcard expansion over them."""

from __future__ import annotations

import re
from fnmatch import fnmatchcase

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import decoded_file_path
from ..options import glob_regex, has_wildcards
from ..sinks.storage import Folder


def object_manifest(spark: SparkSession, root: str, bucket: str) -> DataFrame:
    """List the objects below a root: ``bucket, name, size, mtime``.

    Only the listing is touched: the unused ``content`` column is pruned away.
    """
    base = root.rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(base)
    # Everything behind the root, whatever form the file system gives its scheme.
    tail = base.split(":", 1)[-1].lstrip("/")
    path = decoded_file_path()
    name = F.substring(path, F.locate(tail + "/", path) + F.lit(len(tail) + 1), F.length(path))
    return files.select(
        F.lit(bucket).alias("bucket"),
        name.alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("mtime"),
    )


def expand_wildcard(manifest: DataFrame, pattern: str) -> DataFrame:
    """Distinct folders that match a pattern, segment by segment, in order.

    ``manifest`` holds one bucket. A folder counts when some object lies below it
    (or is its marker). Segments that start with ``_`` or ``.`` are not matched by
    a wildcard.
    """
    segments = pattern.strip("/").split("/")
    fixed = []
    for segment in segments:
        if has_wildcards(segment):
            break
        fixed.append(segment)
    prefix = "".join(part + "/" for part in fixed)
    parts = F.split("name", "/")
    folder = F.array_join(F.slice(parts, 1, len(segments)), "/")
    matching = F.lit(True)
    for position, segment in enumerate(segments[len(fixed) :], start=len(fixed)):
        part = F.get(parts, F.lit(position))
        matching &= part.rlike(glob_regex(segment, cross_slash=False))
        if has_wildcards(segment):
            matching &= ~part.rlike("^[_.]")
    return (
        manifest.filter(F.col("name").startswith(prefix) & (F.size(parts) > len(segments)) & matching)
        .select(folder.alias("path"))
        .distinct()
        .orderBy("path")
    )


def expand_paths(manifest: DataFrame, pattern: str, uri_root: str) -> list[str]:
    """The reader paths a pattern stands for; no match is an error.

    The list holds folders, not files, because a reader needs it on the driver.
    """
    if not has_wildcards(pattern):
        return [f"{uri_root.rstrip('/')}/{pattern.lstrip('/')}"]
    folders = [row.path for row in expand_wildcard(manifest, pattern).collect()]
    if not folders:
        raise FileNotFoundError(f"no folder matches {pattern!r}")
    return [f"{uri_root.rstrip('/')}/{folder}" for folder in folders]


def expand_folders(spark: SparkSession, pattern: str) -> list[str]:
    """The folders a path with wildcards stands for, by the rules of ``expand_wildcard``.

    Only folders that match are listed, one level after the other; what lies below them
    or beside them is not. No match is an error.
    """
    if not has_wildcards(pattern):
        return [pattern]
    fixed = pattern[: re.search(r"[*?]", pattern).start()].rpartition("/")[0]
    found = [fixed]
    for segment in pattern[len(fixed) :].strip("/").split("/"):
        if re.search(r"[*?\[]", segment):
            found = [
                f"{folder}/{name}"
                for folder in found
                for name in Folder(spark, folder or "/").children()
                if fnmatchcase(name, segment) and not (has_wildcards(segment) and name[0] in "_.")
            ]
        else:
            found = [f"{folder}/{segment}" for folder in found]
    found = sorted(folder for folder in found if Folder(spark, folder).holds_files())
    if not found:
        raise FileNotFoundError(f"no folder matches {pattern!r}")
    return found
