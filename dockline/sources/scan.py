"""File scans: one reader call per load, whatever the number of folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import CODECS, FORMATS
from ..functions.paths import decoded_file_path
from ..options import parse_schema, parse_separator
from .compressed import SOURCE_PATH, scan_without_extension


def scan(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str,
    *,
    delimiter: str | None = None,
    has_header: bool = False,
    schema: str | T.StructType | None = None,
    codec: str | None = None,
    recursive: bool = False,
    lineage: bool = False,
) -> DataFrame:
    """Read files of one format from one or many paths.

    ``codec`` names the compression of files that carry no extension for it; files
    with one are recognised by the reader itself. ``lineage`` adds the path of each
    row's file as ``_source_path``. ``recursive`` reads dated
    sub-folders of any depth; leave it off for ``key=value`` roots.
    """
    if fmt not in FORMATS:
        raise ValueError(f"format must be one of {FORMATS}, got {fmt!r}")
    if codec is not None and codec not in CODECS:
        raise ValueError(f"codec must be one of {CODECS}, got {codec!r}")
    struct = parse_schema(schema) if isinstance(schema, str) else schema
    if fmt == "delimited":
        if not delimiter:
            raise ValueError("a delimited scan needs a delimiter")
        separator = parse_separator(delimiter)
    else:
        separator = None
    targets = [paths] if isinstance(paths, str) else list(paths)
    if not targets:
        raise ValueError("nothing to read: no paths")

    if codec not in (None, "none") and fmt in ("delimited", "json"):
        df = scan_without_extension(
            spark, targets, fmt, codec, separator=separator, has_header=has_header, schema=struct, recursive=recursive
        )
        return df if lineage else df.drop(SOURCE_PATH)

    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if struct is not None:
        reader = reader.schema(struct)
    if fmt == "delimited":
        reader = reader.option("sep", separator).option("header", str(has_header).lower())
        if struct is None:
            reader = reader.option("inferSchema", "true")
        reader = reader.format("csv")
    elif fmt == "avro":
        require_avro(spark)
        reader = reader.format("avro")
    else:
        reader = reader.format(fmt)
    df = reader.load(targets)
    return add_lineage(df) if lineage else df


def add_lineage(df: DataFrame, name: str = SOURCE_PATH) -> DataFrame:
    """The path of each row's source file; must sit directly on a file scan.

    As the scan gives it, percent-encoded: see ``source_path`` for reading it.
    """
    return df.select("*", F.col("_metadata.file_path").alias(name))


def source_path(name: str = SOURCE_PATH) -> Column:
    """The decoded lineage path."""
    return decoded_file_path(F.col(name))


def source_files(spark: SparkSession, paths: Sequence[str], recursive: bool) -> DataFrame:
    """One row per input file, its path in the same form as the lineage column.

    Files are listed, not opened.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    files = reader.load(list(paths)).select(F.col("_metadata.file_path").alias(SOURCE_PATH))
    folders = sorted(path.rstrip("/") + "/" for path in paths)
    nested = any(below.startswith(above) for above, below in zip(folders, folders[1:]))
    return files.distinct() if nested else files


def drop_lineage(df: DataFrame, name: str = SOURCE_PATH) -> DataFrame:
    return df.drop(name)


def require_avro(spark: SparkSession) -> None:
    """Fail early and clearly where the Avro module is not on the class path."""
    try:
        spark.read.format("avro").schema("probe string").load([])
    except AnalysisException as error:
        if "avro" in str(error).lower():
            raise RuntimeError(
                "reading Avro needs the spark-avro module; start the session with "
                "spark.jars.packages=org.apache.spark:spark-avro_2.13:<spark version>"
            ) from error


def normalize_timestamps(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as instants (session zone UTC), all in one projection."""
    naive = {f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)}
    if not naive:
        return df
    return df.select(
        *(F.col(f"`{c}`").cast("timestamp").alias(c) if c in naive else F.col(f"`{c}`") for c in df.columns)
    )
