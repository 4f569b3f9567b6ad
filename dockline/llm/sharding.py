"""Shards by jump consistent hashing: no ring table, and growth moves only what it must.

``shard_of`` decides by key and shard count alone (law ``key``): with one more shard a
row either stays or goes to the new one. A null key counts as a fixed key of its own;
rows with equal keys share a shard. Slots count the rows of a shard from 0 without gaps:
rows are numbered within hash slices of a shard and the slices' sizes are summed up, so
no shard has to fit a task. An empty table gives an empty result; other columns stay.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

# Fixed values of the published jump hash.
JUMP_FACTOR = np.uint64(2862933555777941757)
JUMP_SCALE = float(1 << 31)

# A slice of a shard holds about so many rows; there are at least MIN_SLICES.
SLICE_ROWS = 100_000
MIN_SLICES = 64

# Copies of one row are written out in runs of so many.
REPEAT_STEP = 10_000


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard of every unsigned 64-bit key."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    state = keys.astype(np.uint64)
    found = np.zeros(len(state), np.int64)
    at = np.arange(len(state))
    here = np.zeros(len(state), np.float64)
    while len(at):
        found[at] = here.astype(np.int64)
        state = state * JUMP_FACTOR + np.uint64(1)
        here = np.floor((found[at] + 1) * (JUMP_SCALE / ((state >> np.uint64(33)).astype(np.float64) + 1.0)))
        more = here < shards
        at, state, here = at[more], state[more], here[more]
    return found


def shard_of(key: Column, shards: int) -> Column:
    """Jump hash of a key column's 64-bit hash."""

    @pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump(keys.to_numpy(np.int64).view(np.uint64), shards).astype(np.int32))

    return shard(F.xxhash64(key))


def assign(df: DataFrame, key: str, shards: int, *order: str) -> DataFrame:
    """``df`` with ``shard``, ``slot`` and ``grown_shard`` (the shard with one more).

    Equal rows are counted first and written out again at the end, so a row that repeats
    without bound is still one row in the shuffles. ``order`` names columns that tell rows
    of one key apart; all columns must be comparable.
    """
    slices = max(MIN_SLICES, -(-df.select(key).count() // (shards * SLICE_ROWS)))
    placed = (
        df.groupBy(*df.columns)
        .agg(F.count("*").alias("_n"))
        .withColumns({"shard": shard_of(F.col(key), shards), "grown_shard": shard_of(F.col(key), shards + 1)})
        .withColumn("_slice", F.pmod(F.xxhash64(F.lit("slice"), key, *order), F.lit(slices)).cast("int"))
    )
    earlier = (Window.unboundedPreceding, -1)
    sizes = placed.groupBy("shard", "_slice").agg(F.sum("_n").alias("_size"))
    slices_before = Window.partitionBy("shard").orderBy("_slice").rowsBetween(*earlier)
    starts = sizes.withColumn("_start", F.coalesce(F.sum("_size").over(slices_before), F.lit(0))).drop("_size")
    rows_before = Window.partitionBy("shard", "_slice").orderBy(key, *order).rowsBetween(*earlier)
    inside = placed.withColumn("_before", F.coalesce(F.sum("_n").over(rows_before), F.lit(0)))
    step = F.lit(REPEAT_STEP)
    return (
        inside.join(starts, ["shard", "_slice"])
        .withColumn("_first", F.explode(F.sequence(F.lit(0), F.col("_n") - 1, step)))
        .withColumn("_copy", F.explode(F.sequence("_first", F.least(F.col("_first") + step, F.col("_n")) - 1)))
        .withColumn("slot", F.col("_start") + F.col("_before") + F.col("_copy"))
        .drop("_slice", "_start", "_before", "_first", "_copy", "_n")
    )


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Where every document goes: id, size, checksum, law, shard, slot, grown shard."""
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("bigint").alias("size"),
        F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    return assign(rows, "doc_id", shards, "text_crc32", "size").select(
        "doc_id", "size", "text_crc32", "law", "shard", F.col("slot").cast("bigint").alias("slot"), "grown_shard"
    )
