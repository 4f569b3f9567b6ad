"""Row filters and checks over paths, events and rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import SOURCE_EVENT, SOURCE_MANUAL
from ..functions.hashing import first_non_empty
from ..options import glob_regex, java_regex


def path_regex_filter(df: DataFrame, pattern: str, name: str = "name") -> DataFrame:
    """Names in which the pattern is found anywhere."""
    return df.filter(F.col(name).rlike(java_regex(pattern)))


def bucket_filter(df: DataFrame, bucket: str, column: str = "bucket") -> DataFrame:
    return df.filter(F.col(column) == bucket)


def auto_trigger_filter(rules: DataFrame) -> DataFrame:
    """Rules that events may start; a rule that does not say counts as one."""
    return rules.filter(F.coalesce("auto_trigger", F.lit(True)))


def glob_filter(df: DataFrame, pattern: str, name: str = "name") -> DataFrame:
    """Shell-style match of the whole name; ``*`` runs over ``/``."""
    return df.filter(F.col(name).rlike(glob_regex(pattern)))


def event_source(generation: Column) -> Column:
    return F.when(generation.isNull(), F.lit(SOURCE_MANUAL)).otherwise(F.lit(SOURCE_EVENT))


def enum_domain(value: Column, allowed: Sequence[str]) -> Column:
    """Whether a value is in a closed set; NULL is not."""
    return F.coalesce(value.isin(list(allowed)), F.lit(False))


def recent_window_filter(ledger: DataFrame, now: Column, cooldown_micros: Column, key: Column | None = None) -> DataFrame:
    """Ledger records young enough to matter at ``now``, of one key or of all."""
    recent = F.unix_micros("created_at") >= F.unix_micros(now) - cooldown_micros
    return ledger.filter(recent if key is None else recent & (F.col("task_key") == key))


def file_name_required(mode: Column, file_name: Column) -> Column:
    """An error text where a file or marker rule meets an event without a name."""
    absent = mode.isin("file", "marker") & first_non_empty(file_name).isNull()
    return F.when(absent, F.lit("file name required"))
