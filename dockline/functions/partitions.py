"""Partition values from paths, and partition names from values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import GRANULARITY_FORMATS, PARTITION_COLUMN_TYPES
from ..options import java_regex, spark_datetime_pattern


def extract_partition(path: Column, regex: str) -> Column:
    """First capture group of the first match; NULL where nothing is captured."""
    return F.nullif(F.regexp_extract(path, java_regex(regex, need_group=True), 1), F.lit(""))


def parse_partition_value(value: Column, strptime_format: str, column_type: str = "timestamp") -> Column:
    """Strict parse; NULL where the text does not follow the format."""
    check_column_type(column_type)
    parsed = F.try_to_timestamp(value, F.lit(spark_datetime_pattern(strptime_format)))
    return parsed.cast("date") if column_type == "date" else parsed


def partition_from_path(
    path: Column,
    regex: str,
    strptime_format: str,
    column_type: str = "timestamp",
    fail: bool = True,
) -> Column:
    """The partition value a file's path names.

    With ``fail`` a path without a usable value ends the job; otherwise it gives
    NULL, for callers that set such rows aside.
    """
    value = parse_partition_value(extract_partition(path, regex), strptime_format, column_type)
    return F.coalesce(value, no_partition(path, regex, strptime_format, column_type)) if fail else value


def no_partition(path: Column, regex: str, strptime_format: str, column_type: str = "timestamp") -> Column:
    """Ends the job when it is evaluated; typed like the value it stands for."""
    message = F.concat(F.lit(f"no partition value by {regex} and {strptime_format} in path "), F.coalesce(path, F.lit("")))
    return F.raise_error(message).cast("date" if column_type == "date" else "timestamp")


def partition_name(value: Column, granularity: str) -> Column:
    """The physical name (``20240131``, ``202401``, …) of a value's partition."""
    check_granularity(granularity)
    return F.date_format(value, GRANULARITY_FORMATS[granularity])


def check_granularity(granularity: str, column_type: str | None = None) -> None:
    if granularity not in GRANULARITY_FORMATS:
        raise ValueError(f"granularity must be one of {sorted(GRANULARITY_FORMATS)}, got {granularity!r}")
    if granularity == "HOUR" and column_type == "date":
        raise ValueError("a date column cannot carry HOUR partitions; use a timestamp column")


def check_column_type(column_type: str) -> None:
    if column_type not in PARTITION_COLUMN_TYPES:
        raise ValueError(f"partition column type must be one of {PARTITION_COLUMN_TYPES}, got {column_type!r}")
