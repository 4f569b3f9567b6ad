"""What the operators share: stored tables, tables of the corpus, text hashing in blocks."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockline.session import scratch

# Word separators of the contracts, as a Java and Python pattern.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

# Texts are hashed in blocks of about so many bytes, which bounds the arrays of a task.
BLOCK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder and read back: lineage ends there."""
    spark = df.sparkSession
    path = scratch(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, whatever number of times it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array, nulls as empty, and the offsets of its values."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if len(texts) == 0 or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def blocks(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of rows of about ``BLOCK_BYTES`` together."""
    data, offsets = buffers(texts)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + BLOCK_BYTES, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_STEP = 0x9E3779B97F4A7C15 | 1
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)
_IS_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[0x41:0x5B] += np.uint64(0x20)
_BYTE = mix((_LOWER + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(max(count, 1), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_UP, _DOWN = _powers(_STEP, BLOCK_BYTES), _powers(_STEP_INVERSE, BLOCK_BYTES)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the A-Z-lowered words of a block, and each row's first word.

    A word's hash is a polynomial of its bytes, read off running sums of the block.
    """
    n, rows = len(data), len(offsets) - 1
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
    up, down = (_UP, _DOWN) if n <= BLOCK_BYTES else (_powers(_STEP, n), _powers(_STEP_INVERSE, n))
    inside = ~_IS_SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:n]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=sums[1:])
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    return hashes, np.searchsorted(starts, offsets)
