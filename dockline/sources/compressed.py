"""Compressed text files whose names do not tell the codec.

The built-in readers choose a codec by file extension only. So these files are read as
text that ends at line feeds, whose bytes Spark hands on unchanged: any store that Spark
reads will do, large files are read by many tasks, and no file is held whole. One shuffle
of the compressed bytes brings the pieces of a file together in order; a task inflates them
as they come, and the lines are parsed by the engine's own CSV and JSON functions.

Blank lines are skipped, before a header as well. Files may list their columns in different
orders: without a schema each file is read by the names of its own header, and columns that
a file lacks are NULL. With a schema, columns go by position, as in the built-in reader. A
path given twice is read once; so is a folder below another when reading recursively.
"""

from __future__ import annotations

import bz2
import csv
import struct
import zlib
from collections.abc import Iterable, Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch
from ..sinks.storage import drop_folder

SOURCE_PATH = "_source_path"

#: Files of one scan may have so many different headers.
MAX_LAYOUTS = 100

_CHUNK = 4 << 20
_LINES_PER_BATCH = 20_000
_HEADER = -1
#: The reader inflates files of these names itself.
_EXTENSIONS = (".gz", ".bz2", ".snappy", ".deflate")


def scan_without_extension(
    spark: SparkSession,
    paths: list[str],
    fmt: str,
    codec: str,
    *,
    separator: str | None,
    has_header: bool,
    schema: T.StructType | None,
    recursive: bool,
) -> DataFrame:
    pieces = _pieces(spark, _apart(paths, recursive), recursive)
    has_header = has_header and fmt != "json"
    lines = _lines(pieces, codec, has_header, None)
    if fmt == "json":
        if schema is None:
            copy = _text_copy(lines)
            schema = spark.read.json(copy).schema
            drop_folder(spark, copy)
        return _parsed(lines, F.from_json("value", schema))

    headers: list[str] = []
    if has_header and schema is None:
        found = lines.filter(F.col("layout") == _HEADER).groupBy("value").agg(F.min("path").alias("path"))
        headers = [row.value for row in found.orderBy("path").limit(MAX_LAYOUTS + 1).collect()]
        if len(headers) > MAX_LAYOUTS:
            raise ValueError(f"the files have more than {MAX_LAYOUTS} different headers")
        lines = _lines(pieces, codec, True, {header: i for i, header in enumerate(headers)})
    lines = lines.filter(F.col("layout") != _HEADER)
    names = [next(csv.reader([header], delimiter=separator)) for header in headers]
    if len(names) > 1:
        return _by_name(lines, names, separator)

    if schema is None:
        copy = _text_copy(lines)
        schema = _inferred(spark, copy, separator)
        drop_folder(spark, copy)
        if names:
            schema = T.StructType([T.StructField(n, f.dataType, True) for n, f in zip(names[0], schema.fields)])
    return _parsed(lines, F.from_csv("value", _ddl(schema), {"sep": separator}))


def _apart(paths: list[str], recursive: bool) -> list[str]:
    """The paths without repeats, and without those below another when reading recursively."""
    kept: list[str] = []
    for path in sorted({path.rstrip("/") + "/" for path in paths}):
        if not (recursive and kept and path.startswith(kept[-1])):
            kept.append(path)
    return [path.rstrip("/") or path for path in kept]


def _by_name(lines: DataFrame, layouts: list[list[str]], separator: str) -> DataFrame:
    """Lines of files with different headers; a column takes the type that all its files agree on, else string."""
    spark = lines.sparkSession
    copy = scratch(spark, "inflated")
    lines.select("layout", "value").write.partitionBy("layout").text(copy)
    written = spark.read.schema("value string, layout int").text(copy).select("layout").distinct()
    filled = {row.layout for row in written.collect()}
    types: dict[str, set[T.DataType]] = {name: set() for names in layouts for name in names}
    for i in sorted(filled):
        for name, field in zip(layouts[i], _inferred(spark, f"{copy}/layout={i}", separator).fields):
            types[name].add(field.dataType)
    drop_folder(spark, copy)
    final = {name: kinds.pop() if len(kinds) == 1 else T.StringType() for name, kinds in types.items()}

    def record(i: int) -> Column:
        struct_of = T.StructType([T.StructField(name, final[name], True) for name in layouts[i]])
        return F.when(F.col("layout") == i, F.from_csv("value", _ddl(struct_of), {"sep": separator})).alias(f"row{i}")

    def column(name: str) -> Column:
        holders = [F.col(f"row{i}").getField(name) for i in range(len(layouts)) if name in layouts[i]]
        return F.coalesce(*holders).alias(name)

    rows = lines.select(F.col("path").alias(SOURCE_PATH), *(record(i) for i in range(len(layouts))))
    return rows.select(*(column(name) for name in final), SOURCE_PATH)


def _inferred(spark: SparkSession, path: str, separator: str) -> T.StructType:
    return spark.read.option("sep", separator).option("inferSchema", "true").csv(path).schema


def _parsed(lines: DataFrame, record: Column) -> DataFrame:
    return lines.select(F.col("path").alias(SOURCE_PATH), record.alias("row")).select("row.*", SOURCE_PATH)


def _text_copy(lines: DataFrame) -> str:
    """The inflated lines as text files, for the reader to infer a schema from."""
    target = scratch(lines.sparkSession, "inflated")
    lines.select("value").write.text(target)
    return target


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def _pieces(spark: SparkSession, paths: list[str], recursive: bool) -> DataFrame:
    """The compressed bytes between line feeds: ``path, size, value``, each file in one partition and in order."""
    text = (
        spark.read.option("recursiveFileLookup", str(recursive).lower())
        # The text reader does not decode: a cast gives the bytes of the file.
        .option("lineSep", "\n")
        .text(paths)
        .select(
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_size").alias("size"),
            F.col("_metadata.file_block_start").alias("start"),
            F.monotonically_increasing_id().alias("nr"),
            F.col("value").cast("binary").alias("value"),
        )
    )
    return text.repartition("path").sortWithinPartitions("path", "start", "nr").select("path", "size", "value")


def _lines(pieces: DataFrame, codec: str, has_header: bool, layouts: dict[str, int] | None) -> DataFrame:
    """One row per text line: ``path, layout, value``.

    ``layout`` is ``_HEADER`` for a header, else the number of the file's header (0 without ``layouts``).
    """

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (path, size), runs in groupby(_runs(batches), key=lambda run: run[:2]):
            data = (run[2] for run in runs)
            if not path.lower().endswith(_EXTENSIONS):
                data = _INFLATE[codec](_whole(data, size, path))
            yield from _file_batches(path, data, has_header, layouts)

    return pieces.mapInArrow(explode, "path string, layout int, value string")


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[str, int, bytes]]:
    """What a batch holds of one file, as one string of bytes."""
    for batch in batches:
        rows = zip(batch.column("path").to_pylist(), batch.column("size").to_pylist(), batch.column("value").to_pylist())
        for (path, size), run in groupby(rows, key=lambda row: row[:2]):
            yield path, size, b"".join(value + b"\n" for _, _, value in run)


def _whole(data: Iterator[bytes], size: int, path: str) -> Iterator[bytes]:
    """The bytes of a file: without the line feed behind the last piece where the file has none."""
    seen = 0
    for piece in data:
        seen += len(piece)
        yield piece[:-1] if seen == size + 1 else piece
    if seen not in (size, size + 1):
        raise ValueError(f"{path} has {size} bytes, but {seen} were read: it changed, or two paths lead to it")


def _file_batches(
    path: str, data: Iterable[bytes], has_header: bool, layouts: dict[str, int] | None
) -> Iterator[pa.RecordBatch]:
    layout, pending = (None if has_header else 0), []
    for raw in _split(data):
        line = raw.removesuffix(b"\r").decode("utf-8", "replace")
        if not line.strip():
            continue
        if layout is None:
            layout = layouts[line] if layouts else 0
            yield _batch(path, _HEADER, [line])
            continue
        pending.append(line)
        if len(pending) == _LINES_PER_BATCH:
            yield _batch(path, layout, pending)
            pending = []
    if pending:
        yield _batch(path, layout, pending)


def _split(data: Iterable[bytes]) -> Iterator[bytes]:
    """Lines without their line feeds; what a long one is made of is joined once."""
    parts: list[bytes] = []
    for piece in data:
        head, *lines = piece.split(b"\n")
        parts.append(head)
        if lines:
            yield b"".join(parts)
            yield from lines[:-1]
            parts = [lines[-1]]
    if any(parts):
        yield b"".join(parts)


def _batch(path: str, layout: int, lines: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([path] * len(lines), pa.string()), pa.array([layout] * len(lines), pa.int32()), pa.array(lines, pa.string())],
        names=["path", "layout", "value"],
    )


def _gzip(data: Iterable[bytes]) -> Iterator[bytes]:
    # A gzip file may hold several members, and zeros behind them.
    inflater, members = None, 0
    for piece in data:
        while piece:
            if inflater is None:
                piece = piece.lstrip(b"\0") if members else piece
                if not piece:
                    break
                inflater, members = zlib.decompressobj(wbits=31), members + 1
            yield inflater.decompress(piece, _CHUNK)
            if inflater.eof:
                piece, inflater = inflater.unused_data, None
            else:
                piece = inflater.unconsumed_tail
    if inflater is not None:
        raise ValueError("gzip data ends early")


def _bzip2(data: Iterable[bytes]) -> Iterator[bytes]:
    inflater = None
    for piece in data:
        while piece or (inflater is not None and not inflater.needs_input):
            inflater = inflater or bz2.BZ2Decompressor()
            yield inflater.decompress(piece, _CHUNK)
            piece = b""
            if inflater.eof:
                # Bytes past this stream belong to the next one.
                piece, inflater = inflater.unused_data, None
    if inflater is not None:
        raise ValueError("bzip2 data ends early")


class _Feed:
    """Reads given numbers of bytes from pieces of any length."""

    def __init__(self, data: Iterable[bytes]):
        self.data, self.have = iter(data), bytearray()

    def take(self, n: int, optional: bool = False) -> bytes:
        while len(self.have) < n:
            piece = next(self.data, None)
            if piece is None:
                if optional and not self.have:
                    return b""
                raise ValueError("snappy data ends early")
            self.have += piece
        taken = bytes(self.have[:n])
        del self.have[:n]
        return taken


def _snappy(data: Iterable[bytes]) -> Iterator[bytes]:
    """Block-framed snappy: block size, then chunks of size and raw snappy bytes."""
    codec, feed = pa.Codec("snappy"), _Feed(data)
    while head := feed.take(4, optional=True):
        (left,) = struct.unpack(">I", head)
        while left > 0:
            (size,) = struct.unpack(">I", feed.take(4))
            chunk = feed.take(size)
            length = _snappy_length(chunk)
            yield codec.decompress(chunk, decompressed_size=length, asbytes=True)
            left -= length


def _snappy_length(chunk: bytes) -> int:
    # Raw snappy starts with its inflated size as a little-endian varint.
    value = shift = 0
    for byte in chunk:
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            break
        shift += 7
    return value


_INFLATE = {"gzip": _gzip, "bzip2": _bzip2, "snappy": _snappy}
