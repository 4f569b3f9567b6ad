"""Object events from JSON text, with a place for the ones that do not parse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The fields of an object event; the first two are required.
EVENT_FIELDS = (
    "bucket",
    "name",
    "generation",
    "metageneration",
    "time_created",
    "md5_hash",
    "crc32c",
    "etag",
    "media_link",
    "self_link",
    "kind",
    "manual_hint",
)
EVENT_REQUIRED = ("bucket", "name")
EVENT_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in EVENT_FIELDS] + [T.StructField("force_run", T.BooleanType())]
)

# The fields of a ledger record, all required, no others allowed.
LEDGER_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("task_key", "source", "event_uid", "content_hash")]
    + [T.StructField(name, T.TimestampType()) for name in ("created_at", "scheduled_at", "cooldown_until", "expire_at")]
    + [T.StructField(name, T.StringType()) for name in ("bucket", "name", "job_uid")]
)


def missing_fields(record: Column, required: Sequence[str]) -> Column:
    """``missing:<field>`` for every required field that is NULL."""
    return F.array_compact(
        F.array(*(F.when(record[name].isNull(), F.lit(f"missing:{name}")) for name in required))
    )


def unexpected_fields(raw: Column, known: Sequence[str]) -> Column:
    """Top-level keys of a JSON text that a record must not have."""
    keys = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    return F.array_except(keys, F.array(*(F.lit(name) for name in known)))


def parse_records(
    df: DataFrame,
    raw: str,
    schema: T.StructType,
    required: Sequence[str],
    forbid_extra: bool = False,
) -> DataFrame:
    """``raw, record, reasons``: a record is valid when it has no reasons."""
    corrupt = "_corrupt"
    typed = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt}
    parsed = df.select(
        F.col(raw).alias("raw"),
        F.from_json(F.col(raw), typed, options).alias("parsed"),
    )
    names = [field.name for field in schema.fields]
    record = F.struct(*(F.col(f"parsed.{name}").alias(name) for name in names))
    broken = F.col("parsed").isNull() | F.col(f"parsed.{corrupt}").isNotNull()
    reasons = F.when(broken, F.array(F.lit("malformed"))).otherwise(missing_fields(F.col("parsed"), required))
    if forbid_extra:
        extra = F.transform(unexpected_fields(F.col("raw"), names), lambda key: F.concat(F.lit("unexpected:"), key))
        reasons = F.concat(reasons, F.when(broken, F.array().cast("array<string>")).otherwise(extra))
    return parsed.select("raw", record.alias("record"), reasons.alias("reasons"))


def parse_events(df: DataFrame, raw: str = "value") -> DataFrame:
    """Object events: unknown keys are ignored, ``force_run`` is off unless set."""
    return parse_records(df, raw, EVENT_SCHEMA, EVENT_REQUIRED)


def valid_events(parsed: DataFrame) -> DataFrame:
    return (
        parsed.filter(F.size("reasons") == 0)
        .select("record.*")
        .withColumn("force_run", F.coalesce("force_run", F.lit(False)))
    )


def rejected_records(parsed: DataFrame) -> DataFrame:
    """The dead letters: raw text and why it was refused."""
    return parsed.filter(F.size("reasons") > 0).select("raw", "reasons")
