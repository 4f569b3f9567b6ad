"""Partitioned tables and the three ways a load replaces their rows.

All writes go through one dynamic partition overwrite. Its files are staged below
the target and take the place of the old partitions only when the whole job has
succeeded, so a load that fails (say, on a path without a date) leaves the table
as it was. A full overwrite writes a version of the table that becomes current in one
step (``versions``), so read tables by ``read_table``. Each write is a single pass: row
count and partition names come from metrics of the write itself.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import PART_ID
from ..functions.partitions import check_column_type, check_granularity, partition_name
from .schema import conformed, merge_schemas, relaxed, store_schema, stored_schema
from .storage import Folder
from .versions import data_folder, new_version, publish, sweep, version_folder


# A load may bring each row's partition name along in this column, where it was
# worked out once per file; otherwise it follows from the partition column.
KNOWN_PART_ID = "_part_id"


@dataclass(frozen=True)
class TableSpec:
    path: str
    partition_column: str = "date"
    granularity: str = "DAY"
    column_type: str = "timestamp"
    cluster_by: Sequence[str] = field(default_factory=tuple)
    create: bool = True
    # Number of write tasks. By default Spark sizes tasks by bytes, which gives too few
    # where a load has very many tiny partitions: each of them costs a file.
    tasks: int | None = None
    # Upper bound of rows in one file, for partitions that are much larger than others.
    max_records_per_file: int = 0

    def __post_init__(self):
        check_column_type(self.column_type)
        check_granularity(self.granularity, self.column_type)


@dataclass(frozen=True)
class WriteResult:
    row_count: int
    partitions: list[str]


class MissingTable(ValueError):
    """The target does not exist and the load may not create it."""


def overwrite_table(df: DataFrame, table: TableSpec) -> WriteResult:
    """Replace the whole table; readers see either the old one or the new one."""
    spark = df.sparkSession
    version = new_version(spark, table.path)
    result = _write(df, table, target=version_folder(table.path, version))
    publish(spark, table.path, version)
    sweep(spark, table.path)
    return result


def overwrite_partition_range(df: DataFrame, table: TableSpec) -> WriteResult:
    """Replace every partition the input has rows for; keep the others.

    Partitions are told apart by name, so a value finer than the granularity
    replaces its whole partition. An empty input changes nothing.
    """
    return _write(df, table)


def overwrite_partition(df: DataFrame, table: TableSpec, value: date | datetime | str) -> WriteResult:
    """Replace the one partition of ``value``; an empty input empties it."""
    spark = df.sparkSession
    # As text: a naive datetime would be read in the zone of this process.
    moment = F.lit(str(value)).cast("timestamp")
    part = partition_name(moment, table.granularity)
    name = spark.range(1).select(part.alias("name")).head().name
    marked = df.withColumn(table.partition_column, moment.cast(table.column_type))
    result = _write(marked, table, part_id=F.lit(name))
    if result.row_count == 0:
        folder = Folder(spark, data_folder(spark, table.path))
        child = f"{PART_ID}={name}"
        if child in folder.children():
            folder.remove(child)
    return WriteResult(result.row_count, [name])


def _write(
    df: DataFrame, table: TableSpec, part_id: Column | None = None, target: str | None = None
) -> WriteResult:
    """Replace partitions in the folder that holds the table, or fill the one given."""
    spark = df.sparkSession
    home = data_folder(spark, table.path)
    target = target or home
    if PART_ID in (c.lower() for c in df.columns):
        raise ValueError(f"the input has a column named {PART_ID}")
    if part_id is None:
        brought = KNOWN_PART_ID in df.columns
        part_id = F.col(KNOWN_PART_ID) if brought else partition_name(F.col(table.partition_column), table.granularity)
    load = T.StructType([f for f in df.schema.fields if f.name != KNOWN_PART_ID])
    known = stored_schema(spark, home)
    if known is None and not table.create and not Folder(spark, table.path).exists():
        raise MissingTable(f"table {table.path} does not exist")
    schema = merge_schemas(known, load) if known is not None else relaxed(load)
    rows = _distribute(df.select(*conformed(df, schema), part_id.alias(PART_ID)), table)
    metrics = Observation()
    # Observed behind the shuffle, in the tasks that write.
    rows = rows.observe(metrics, F.count(F.lit(1)).alias("rows"), F.collect_set(PART_ID).alias("partitions"))
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(PART_ID)
    if table.max_records_per_file:
        writer = writer.option("maxRecordsPerFile", table.max_records_per_file)
    writer.parquet(target)
    if schema != known or target != home:
        store_schema(spark, target, schema)
    seen = metrics.get
    return WriteResult(seen["rows"], sorted(seen["partitions"]))


def _distribute(df: DataFrame, table: TableSpec) -> DataFrame:
    """Few files per partition, none of them huge.

    Usually rows are rebalanced by partition: small partitions share a task and a
    partition too large for one task is split. With clustering or a given number of
    tasks, rows are range-partitioned by partition and fields; files then cover
    narrow ranges that readers skip by their statistics. The trailing hash splits
    hot values and large partitions. This samples the input first.
    """
    if not table.cluster_by and not table.tasks:
        return df.hint("rebalance", PART_ID)
    plain = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    keys = [PART_ID, *table.cluster_by]
    spread = df.withColumn("_spread", F.xxhash64(*plain))
    ranged = spread.repartitionByRange(*([table.tasks] if table.tasks else []), *keys, "_spread")
    return ranged.drop("_spread").sortWithinPartitions(*keys)


def read_table(
    spark: SparkSession,
    path: str,
    between: tuple[str, str] | None = None,
    with_part_id: bool = False,
) -> DataFrame:
    """A table in its current schema: no file is opened to find it.

    ``between`` bounds the partition names (both ends included) and skips all
    other folders. Names of one granularity sort like their times.
    """
    home = data_folder(spark, path)
    schema = stored_schema(spark, home)
    if schema is None:
        raise MissingTable(f"table {path} does not exist")
    full = T.StructType([*schema.fields, T.StructField(PART_ID, T.StringType())])
    if not any(name.startswith(f"{PART_ID}=") for name in Folder(spark, home).children()):
        df = spark.createDataFrame([], full)
    else:
        df = spark.read.schema(full).parquet(home)
    if between is not None:
        df = df.filter(F.col(PART_ID).between(*between))
    return df if with_part_id else df.drop(PART_ID)
