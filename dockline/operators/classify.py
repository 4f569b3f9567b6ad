"""What a path is: a file, a folder, or nothing at all."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import ancestor_folders, folder_depth, has_wildcards, strip_filename, trim_slashes


# An index up to this many paths may be broadcast (some hundred bytes each).
BROADCAST_PATHS = 200_000


def path_index(manifest: DataFrame) -> DataFrame:
    """Every object and every folder above one: ``bucket, path, is_file``.

    Ancestors repeat once per object below them; the aggregate folds them inside
    each map task, so a folder that holds everything shuffles few rows.
    """
    entries = F.concat(
        F.array(F.struct(F.col("name").alias("path"), (~F.col("name").endswith("/")).alias("is_file"))),
        F.transform(ancestor_folders(F.col("name")), lambda folder: F.struct(folder.alias("path"), F.lit(False).alias("is_file"))),
    )
    return (
        manifest.select("bucket", F.explode(entries).alias("entry"))
        .groupBy("bucket", F.col("entry.path").alias("path"))
        .agg(F.bool_or("entry.is_file").alias("is_file"))
    )


def _most_paths(manifest: DataFrame) -> int:
    """No fewer paths than the index has, but for the estimate: objects times the levels of the deepest."""
    found = manifest.agg(
        F.approx_count_distinct(F.xxhash64("bucket", "name")).alias("objects"),
        F.coalesce(F.max(folder_depth(F.col("name"))), F.lit(0)).alias("depth"),
    ).first()
    return found.objects * (1 + found.depth)


def classify_paths(paths: DataFrame, manifest: DataFrame, path: str = "path") -> DataFrame:
    """Add ``path_class``: ``file``, ``folder`` or ``not_found``.

    The bucket root is a folder; an object wins over a folder of the same name.
    Objects that are listed often make a small index: it is broadcast, so the paths
    asked for, of which there may be many times more, are neither shuffled nor sorted.
    """
    index = path_index(manifest).select(
        F.col("bucket").alias("_bucket"), F.col("path").alias("_path"), F.col("is_file").alias("_is_file")
    )
    if _most_paths(manifest) <= BROADCAST_PATHS:
        index = F.broadcast(index)
    wanted = F.col("_wanted")
    return (
        paths.withColumn("_wanted", trim_slashes(F.coalesce(F.col(path), F.lit(""))))
        .join(index, (F.col("bucket") == F.col("_bucket")) & (wanted == F.col("_path")), "left")
        .withColumn(
            "path_class",
            F.when(wanted == "", F.lit("folder"))
            .when(F.col("_is_file"), F.lit("file"))
            .when(F.col("_is_file").isNotNull(), F.lit("folder"))
            .otherwise(F.lit("not_found")),
        )
        .drop("_bucket", "_path", "_is_file", "_wanted")
    )


def resolve_input_path(requests: DataFrame, manifest: DataFrame) -> DataFrame:
    """The path a request loads, by its mode: adds ``input_path`` and ``error``.

    Folder rules need a folder, file and marker rules must not have one; a marker
    stands for its folder. Paths with wildcards are taken as they are.
    """
    wild = has_wildcards(F.col("name"))
    kind = F.col("path_class")
    problem = (
        F.when(wild, F.lit(None).cast("string"))
        .when(kind == "not_found", F.lit("path not found"))
        .when((F.col("mode") == "folder") & (kind != "folder"), F.lit("not a folder"))
        .when((F.col("mode") != "folder") & (kind == "folder"), F.lit("is a folder"))
    )
    resolved = F.when(F.col("mode") == "marker", strip_filename(F.col("name"))).otherwise(F.col("name"))
    return (
        classify_paths(requests, manifest, path="name")
        .withColumn("error", problem)
        .withColumn("input_path", F.when(F.col("error").isNull(), resolved))
        .drop("path_class")
    )
