"""How a table's schema takes in a new load."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..constants import PART_ID
from .storage import Folder

# Beside the data; readers skip names with a leading underscore.
SCHEMA_FOLDER = "_schema"


class SchemaConflict(ValueError):
    """A column changed its type; found before anything is written."""


def relaxed(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


def merge_schemas(table: T.StructType, load: T.StructType) -> T.StructType:
    """Columns of the table in order, then the new ones; everything may be NULL."""
    known = {f.name.lower(): f for f in table.fields}
    added = []
    for field in load.fields:
        old = known.get(field.name.lower())
        if old is None:
            added.append(field)
        elif relaxed_type(old.dataType) != relaxed_type(field.dataType):
            raise SchemaConflict(
                f"column {field.name}: the table has {old.dataType.simpleString()}, "
                f"the load has {field.dataType.simpleString()}"
            )
    return relaxed(T.StructType([*table.fields, *added]))


def relaxed_type(kind: T.DataType) -> T.DataType:
    """A type without its nullability, which may differ between loads."""
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(relaxed_type(kind.elementType), True)
    if isinstance(kind, T.MapType):
        return T.MapType(relaxed_type(kind.keyType), relaxed_type(kind.valueType), True)
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f.name, relaxed_type(f.dataType), True) for f in kind.fields])
    return kind


def conformed(df: DataFrame, schema: T.StructType) -> list[Column]:
    """The load's values for the table's columns; ones it lacks are NULL."""
    present = {c.lower(): c for c in df.columns}
    return [
        F.col(f"`{present[f.name.lower()]}`").alias(f.name)
        if f.name.lower() in present
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]


def stored_schema(spark: SparkSession, path: str) -> T.StructType | None:
    """The schema kept with a table; else the one of its files; else None.

    Needed because an empty table has no files, and because the files of older
    loads lack columns added since.
    """
    table = Folder(spark, path)
    if not table.exists():
        return None
    if SCHEMA_FOLDER in table.children():
        row = spark.read.text(f"{path}/{SCHEMA_FOLDER}").head()
        if row:
            return T.StructType.fromJson(json.loads(row.value))
    if not any(name.startswith(f"{PART_ID}=") for name in table.children()):
        return None
    found = spark.read.option("mergeSchema", "true").parquet(path).schema
    return relaxed(T.StructType([f for f in found.fields if f.name != PART_ID]))


def store_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    # One short line of text.
    spark.createDataFrame([(schema.json(),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/{SCHEMA_FOLDER}"
    )
