"""A whole load: scan, partition value from the path, checks, write, audit."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.partitions import (
    extract_partition,
    no_partition,
    parse_partition_value,
    partition_from_path,
    partition_name,
)
from ..sinks.storage import drop_folder, refuse_overlap
from ..sinks.table import (
    KNOWN_PART_ID,
    TableSpec,
    WriteResult,
    overwrite_partition,
    overwrite_partition_range,
    overwrite_table,
)
from ..sources.manifest import expand_folders
from ..sources.scan import SOURCE_PATH, normalize_timestamps, scan, source_files, source_path

MODES = ("table", "partition", "partition_range")
POLICIES = ("fail", "quarantine")

# File paths with their values, about 300 bytes each, are broadcast up to this many.
BROADCAST_FILES = 200_000

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_uuid", T.StringType()),
        T.StructField("job", T.StringType()),
        T.StructField("target", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("input_paths", T.ArrayType(T.StringType())),
        T.StructField("columns", T.ArrayType(T.StringType())),
        T.StructField("row_count", T.LongType()),
        T.StructField("partition_count", T.LongType()),
        T.StructField("partitions", T.ArrayType(T.StringType())),
        T.StructField("rejected_count", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
    ]
)


@dataclass(frozen=True)
class LoadSpec:
    """What to read, where the partition value stands in a path, and what to replace."""

    job: str
    fmt: str
    table: TableSpec
    partition_regex: str
    partition_format: str
    mode: str = "table"
    delimiter: str | None = None
    has_header: bool = False
    schema: str | T.StructType | None = None
    codec: str | None = None
    # ``key=value`` roots are read by partition discovery, all others recursively.
    recursive: bool = True
    # Only the path behind this text is searched for the partition value.
    path_root: str | None = None
    on_error: str = "fail"
    quarantine_path: str | None = None
    staging_path: str | None = None
    audit_path: str | None = None
    transform: Callable[..., DataFrame] | None = None
    params: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}, got {self.mode!r}")
        if self.on_error not in POLICIES:
            raise ValueError(f"on_error must be one of {POLICIES}, got {self.on_error!r}")
        if self.on_error == "quarantine" and not self.quarantine_path:
            raise ValueError("quarantine needs a quarantine_path")


def run_load(
    spark: SparkSession,
    spec: LoadSpec,
    paths: str | Sequence[str],
    run_uuid: str,
    *,
    dry_run: bool = False,
) -> DataFrame:
    """Run a load and return its audit row; a dry run returns the row only.

    The audit row of a failed load is stored too, before the error goes on.
    """
    started = datetime.now(timezone.utc)
    inputs = [paths] if isinstance(paths, str) else list(paths)
    columns: list[str] = []
    try:
        inputs = [p for path in inputs for p in expand_folders(spark, path)]
        refuse_overlap(spark, inputs, spec.table.path)
        source = _source(spark, spec, inputs, spec.schema)
        if dry_run:
            columns = [c for c in source.columns if c != SOURCE_PATH]
            return _audit(spark, spec, run_uuid, inputs, columns, None, None, "dry_run", None, started)
        files = source_files(spark, inputs, spec.recursive)
        rejected = _quarantine(source, files, spec, run_uuid) if spec.on_error == "quarantine" else 0
        df = normalize_timestamps(source)
        if spec.mode == "partition":
            value = _path_value(spark, spec, inputs)
            if rejected:
                # What was set aside is not loaded as well.
                df = df.filter(_value_in_path(spec)[1].isNotNull())
            df = df.drop(SOURCE_PATH)
        else:
            df = with_partition(df, spec, files)
        if spec.transform is not None:
            # The caller's step may move rows to other partitions.
            df = spec.transform(df.drop(KNOWN_PART_ID), spec.params)
        if spec.staging_path:
            df = _staged(df, f"{spec.staging_path}/{run_uuid}")
        columns = [c for c in df.columns if c != KNOWN_PART_ID]
        if spec.mode == "partition":
            result = overwrite_partition(df, spec.table, value)
        elif spec.mode == "partition_range":
            result = overwrite_partition_range(df, spec.table)
        else:
            result = overwrite_table(df, spec.table)
        if spec.staging_path:
            drop_folder(spark, f"{spec.staging_path}/{run_uuid}")
    except Exception as error:
        failed = _audit(spark, spec, run_uuid, inputs, columns, None, None, "failed", str(error), started)
        _store_audit(failed, spec)
        raise
    done = _audit(spark, spec, run_uuid, inputs, columns, result, rejected, "succeeded", None, started)
    _store_audit(done, spec)
    return done


def with_partition(df: DataFrame, spec: LoadSpec, files: DataFrame | None = None) -> DataFrame:
    """The partition column from each row's file path; the path itself is dropped.

    A path is the same for all rows of a file, and parsing it costs more than
    reading a row. Given the list of files, it is parsed once per file and joined,
    unless the files are too many to broadcast.
    """
    path = _searched(spec, source_path())
    column, kind = spec.table.partition_column, spec.table.column_type
    value = partition_from_path(path, spec.partition_regex, spec.partition_format, kind, fail=False)
    name = partition_name(F.col("_value"), spec.table.granularity)
    if files is not None and files.limit(BROADCAST_FILES + 1).count() <= BROADCAST_FILES:
        values = files.select(SOURCE_PATH, value.alias("_value")).withColumn(KNOWN_PART_ID, name)
        rows = df.join(F.broadcast(values), SOURCE_PATH, "left")
    else:
        rows = df.withColumn("_value", value).withColumn(KNOWN_PART_ID, name)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in (SOURCE_PATH, column)]
    if spec.on_error == "quarantine":
        # Rows without a value have been set aside.
        return rows.filter(F.col("_value").isNotNull()).select(*kept, F.col("_value").alias(column), KNOWN_PART_ID)
    missing = no_partition(path, spec.partition_regex, spec.partition_format, kind)
    return rows.select(*kept, F.coalesce("_value", missing).alias(column), KNOWN_PART_ID)


def _searched(spec: LoadSpec, path: Column) -> Column:
    """The part of a path in which the partition value stands."""
    if not spec.path_root:
        return path
    return F.substring(path, F.locate(spec.path_root, path) + F.lit(len(spec.path_root)), F.length(path))


def _path_value(spark: SparkSession, spec: LoadSpec, inputs: list[str]) -> str:
    """The one partition value the input path itself names."""
    if len(inputs) != 1:
        raise ValueError("replacing one partition takes one input path")
    value = partition_from_path(_searched(spec, F.lit(inputs[0])), spec.partition_regex, spec.partition_format)
    return spark.range(1).select(value.cast("string").alias("value")).head().value


def _source(spark: SparkSession, spec: LoadSpec, paths: list[str], schema: str | T.StructType | None) -> DataFrame:
    return scan(
        spark,
        paths,
        spec.fmt,
        delimiter=spec.delimiter,
        has_header=spec.has_header,
        schema=schema,
        codec=spec.codec,
        recursive=spec.recursive,
        lineage=True,
    )


def _value_in_path(spec: LoadSpec) -> tuple[Column, Column]:
    """The partition text in a row's path, and its value; NULL without one."""
    text = extract_partition(_searched(spec, source_path()), spec.partition_regex)
    return text, parse_partition_value(text, spec.partition_format, spec.table.column_type)


def _quarantine(source: DataFrame, files: DataFrame, spec: LoadSpec, run_uuid: str) -> int:
    """Set aside the rows of files whose path names no partition; their number.

    The file list tells whether there are any; if so, the source is filtered by path.
    """
    text, value = _value_in_path(spec)
    data = T.StructType([f for f in source.schema.fields if f.name != SOURCE_PATH])
    if files.filter(value.isNull()).isEmpty():
        return 0
    reason = F.when(text.isNull(), F.lit("no partition in path")).otherwise(F.lit("malformed partition value"))
    rejects = source.filter(value.isNull()).select(
        F.lit(run_uuid).alias("run_uuid"),
        source_path().alias("path"),
        F.to_json(F.struct(*(F.col(f"`{c}`") for c in data.names))).alias("raw"),
        F.array(reason).alias("reasons"),
    )
    return quarantine_sink(rejects, spec.quarantine_path)


def quarantine_sink(rejects: DataFrame, path: str, run: str = "run_uuid") -> int:
    """Store rejected records by run; running again replaces them. Returns their number."""
    seen = Observation()
    counted = rejects.observe(seen, F.count(F.lit(1)).alias("rows"))
    counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(run).parquet(path)
    return seen.get["rows"]


def _staged(df: DataFrame, path: str) -> DataFrame:
    """Write the finished rows elsewhere first, so the table only sees whole loads."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _audit(
    spark: SparkSession,
    spec: LoadSpec,
    run_uuid: str,
    inputs: list[str],
    columns: list[str],
    result: WriteResult | None,
    rejected: int | None,
    status: str,
    error: str | None,
    started: datetime,
) -> DataFrame:
    partitions = result.partitions if result else None
    row = (
        run_uuid,
        spec.job,
        spec.table.path,
        spec.mode,
        inputs,
        columns,
        result.row_count if result else None,
        len(partitions) if result else None,
        partitions,
        rejected,
        status,
        error,
        started,
        datetime.now(timezone.utc),
    )
    return spark.createDataFrame([row], AUDIT_SCHEMA)


def _store_audit(row: DataFrame, spec: LoadSpec) -> None:
    if spec.audit_path:
        # A run that is repeated replaces its row.
        row.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_uuid").json(spec.audit_path)


def convert_format(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str,
    target: str,
    target_fmt: str,
    target_codec: str | None = None,
    **options,
) -> None:
    """Read one format and write another, codec included; files stay one to one."""
    refuse_overlap(spark, [paths] if isinstance(paths, str) else list(paths), target)
    df = scan(spark, paths, fmt, **options)
    writer = df.write.mode("overwrite")
    if target_codec:
        writer = writer.option("compression", target_codec)
    if target_fmt == "delimited":
        writer.option("header", "true").csv(target)
    else:
        writer.format(target_fmt).save(target)
