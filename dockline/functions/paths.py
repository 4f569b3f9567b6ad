"""Object names and URIs as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trim_slashes(path: Column) -> Column:
    return F.btrim(path, F.lit("/"))


def strip_filename(path: Column) -> Column:
    """``a/b/c.csv`` to ``a/b/``; a folder stays; a bare name becomes ``/``."""
    last = F.substring_index(path, "/", -1)
    parent = F.rtrim(F.left(path, F.length(path) - F.length(last)), F.lit("/"))
    return F.when(path.endswith("/"), path).otherwise(F.concat(parent, F.lit("/")))


def last_segment(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def has_wildcards(path: Column) -> Column:
    return path.contains("*") | path.contains("?")


def build_uri(bucket: Column, path: Column, scheme: str = "gs") -> Column:
    return F.concat(F.lit(f"{scheme}://"), bucket, F.lit("/"), path)


def uri_bucket(uri: Column) -> Column:
    return F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/]*)", 1)


def uri_path(uri: Column) -> Column:
    return F.regexp_extract(uri, r"(?s)^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/?(.*)\z", 1)


def split_fqn(name: Column) -> Column:
    """``dataset.table`` to its parts."""
    return F.split(name, r"\.")


def join_fqn(*parts: Column) -> Column:
    return F.concat_ws(".", *parts)


def task_key_folder(bucket: Column, name: Column) -> Column:
    """Bucket and parent folder; a name without a folder stays whole."""
    return F.concat(bucket, F.lit("/"), F.regexp_replace(name, r"/[^/]*\z", ""))


def task_key_full(bucket: Column, name: Column) -> Column:
    return F.concat(bucket, F.lit("/"), name)


def event_uid(bucket: Column, name: Column, generation: Column) -> Column:
    """``bucket/name/generation``; NULL while there is no generation."""
    return F.concat(bucket, F.lit("/"), name, F.lit("/"), generation)


def is_manual(generation: Column) -> Column:
    return generation.isNull()


def folder_depth(path: Column) -> Column:
    """The number of folders above an object."""
    return F.octet_length(path) - F.octet_length(F.replace(path, F.lit("/"), F.lit("")))


def ancestor_folders(path: Column) -> Column:
    """Every folder above an object: ``a/b/c.csv`` to ``[a, a/b]``.

    A folder marker ``a/b/`` is above itself.
    """
    depth = folder_depth(path)
    folders = F.transform(F.sequence(F.lit(1), depth), lambda i: F.call_function("substring_index", path, F.lit("/"), i))
    return F.when(depth > 0, folders).when(depth == 0, F.array().cast("array<string>"))


def decoded_file_path(path: Column | None = None) -> Column:
    """A scan's file path with percent escapes resolved (``+`` is literal there)."""
    path = F.col("_metadata.file_path") if path is None else path
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    # Most paths have no escapes, and decoding costs more than looking.
    return F.when(F.contains(path, F.lit("%")), decoded).otherwise(path)
