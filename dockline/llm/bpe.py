"""Byte-level BPE by a global shuffle of distinct words.

* Explode: the pre-tokens of a chunk of documents (the matches of the vocabulary's pattern)
  become positions in the chunk's list of distinct words, the most frequent first. Texts are
  split once; word lists and position lists leave in one shuffle, words to their buckets.
* Encode: word lists are shuffled by a hash of the word, so all copies of a word meet in
  one bucket, where its merges are worked out once, by the rank file.
* Join back: a bucket's ids return to the chunks that asked for them.
* Reassemble: a document's ids follow from its positions. Decoding looks every id up in the
  token-byte table of the vocabulary.

A chunk is a bounded run of rows of one partition, a word goes to a bucket once per chunk
however often it occurs: a word that fills a third of the corpus is no hot key. A chunk is
named by its partition and number there, so equal chunks stay apart. The number of partitions
follows the input's splits, and ``spark.sql.shuffle.partitions`` if that is more. Documents
must come in the same order if a task is run again, as they do from files; store the result
of a shuffle first. A text counts whole, as a chunk of its own if it is long.

Null texts count as empty; empty ones have no ids. Every row gives one row, repeated rows
too. Special tokens are never matched. An empty table gives an empty result, other columns
are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections import defaultdict
from itertools import chain, count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Characters of a chunk, about; a longer document is a chunk of its own.
CHUNK_CHARS = 32_000_000
# Rows of position lists hold about so many positions, or one document.
ROW_POSITIONS = 1_000_000
BUCKETS_PER_PARTITION = 4
# Partitions of the shuffles for each split of the input.
PARTS_EACH = 2
# A bucket forgets its words beyond so many, and would encode them anew.
BUCKET_WORDS = 2_000_000

_SHARED = "chunk bigint, bucket int, part int, doc_ids array<bigint>, sizes array<int>, first binary, second binary"
_NAMES = ["chunk", "bucket", "part", "doc_ids", "sizes", "first", "second"]
_TYPES = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary(), pa.binary()]


def ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in file if line.strip())}


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), _TYPES)], names=_NAMES)


def _squeeze(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def _widen(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def _pieces(values: list[bytes]) -> bytes:
    """Byte strings as one: their number and lengths, then themselves."""
    lengths = np.array([len(values), *map(len, values)], "<u4")
    return _squeeze(lengths.tobytes() + b"".join(values))


def _unpieced(data: bytes) -> list[bytes]:
    data = _widen(data)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    edges = np.cumsum(np.frombuffer(data, "<u4", n + 1)[1:], dtype=np.int64) + 4 * (n + 1)
    edges = [4 * (n + 1), *edges.tolist()]
    return [data[a:b] for a, b in zip(edges[:-1], edges[1:])]


# Ranks below ONE take a byte, those below ONE + TWO * 256 two, others three.
ONE, TWO = 200, 40


def _narrow(ranks_: np.ndarray) -> bytes:
    """Ranks as first, second and third bytes, each kind together, squeezed."""
    x = ranks_.astype(np.int64)
    short, far = x < ONE, x >= ONE + TWO * 256
    middle = ~short & ~far
    if len(x) and int(x.max()) >= ONE + TWO * 256 + ((256 - ONE - TWO) << 16):
        raise ValueError("a chunk has too many distinct words")
    y, z = x - ONE, x - ONE - TWO * 256
    first = np.where(short, x, np.where(middle, ONE + (y >> 8), ONE + TWO + (z >> 16))).astype(np.uint8)
    second = np.where(middle, y, z >> 8)[~short].astype(np.uint8)
    third = z[far].astype(np.uint8)
    return _pieces([_squeeze(part.tobytes()) for part in (first, second, third)])


def _broad(data: bytes) -> np.ndarray:
    first, second, third = (np.frombuffer(_widen(part), np.uint8).astype(np.int64) for part in _unpieced(data))
    out = first.copy()
    more, far = first >= ONE, first >= ONE + TWO
    middle = more & ~far
    high = np.zeros(len(first), np.int64)
    high[more] = second
    out[middle] = ONE + ((first[middle] - ONE) << 8) + high[middle]
    out[far] = ONE + TWO * 256 + ((first[far] - ONE - TWO) << 16) + (high[far] << 8) + third
    return out


class _Chunk:
    """The distinct words of a run of documents, and their positions."""

    def __init__(self):
        self.chars = 0
        self.words: dict[str, int] = defaultdict(count().__next__)
        self.doc_ids, self.places = [], []

    def add(self, doc_id, words: list[str], chars: int) -> None:
        self.doc_ids.append(doc_id)
        self.places.append(np.fromiter(map(self.words.__getitem__, words), "<u4", len(words)))
        self.chars += chars

    def ranked(self) -> tuple[np.ndarray, list[bytes]]:
        """The rank of every word, and the words by rank."""
        uses = np.bincount(np.concatenate(self.places), minlength=len(self.words)) if self.places else np.zeros(0, np.int64)
        order = np.argsort(-uses, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        words = [w.encode() for w in self.words]
        return rank, [words[i] for i in order.tolist()]

    def rows(self, name: int, buckets: int):
        """Rows of positions, then rows of words."""
        rank, words = self.ranked()
        yield from self._position_rows(name, rank)
        yield from self._word_rows(name, words, buckets)

    def _position_rows(self, name: int, rank: np.ndarray):
        first, held = 0, 0
        for at, places in enumerate(self.places):
            held += len(places)
            if held >= ROW_POSITIONS or at + 1 == len(self.places):
                here = self.places[first : at + 1]
                blob = _narrow(rank[np.concatenate(here)])
                yield (name, -1, first, self.doc_ids[first : at + 1], [len(p) for p in here], blob, None)
                first, held = at + 1, 0

    def _word_rows(self, name: int, words: list[bytes], buckets: int):
        home = np.array([xxhash.xxh64_intdigest(w) % buckets for w in words], np.int64)
        order = np.argsort(home, kind="stable")
        edges = np.flatnonzero(np.diff(home[order], prepend=-1, append=-1)) if words else []
        for a, b in zip(edges[:-1], edges[1:]):
            here = order[a:b]
            steps = np.diff(here, prepend=0).astype("<u4")
            yield (name, int(home[here[0]]), 0, None, None, _pieces([words[i] for i in here]), _squeeze(steps.tobytes()))


def _explode(pattern: str, buckets: int):
    def exploded(batches):
        import regex

        find = regex.compile(pattern).findall
        chunk, name = _Chunk(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py() or ""
                chunk.add(doc_id, find(text), len(text))
                if chunk.chars >= CHUNK_CHARS:
                    yield from (_rows([row]) for row in chunk.rows(name, buckets))
                    chunk, name = _Chunk(), name + 1
        if chunk.doc_ids:
            yield from (_rows([row]) for row in chunk.rows(name, buckets))

    return exploded


def _encode(path: str):
    def encoded(batches):
        import tiktoken

        coder = tiktoken.Encoding("words", pat_str=r"(?s).+", mergeable_ranks=ranks(path), special_tokens={})
        bucket, known = None, {}
        for batch in batches:
            # Positions only pass by.
            listed = pc.less(batch.column("bucket"), 0)
            if pc.any(listed).as_py():
                yield batch.filter(listed)
                batch = batch.filter(pc.invert(listed))
            out = []
            for row in batch.to_pylist():
                if row["bucket"] != bucket or len(known) > BUCKET_WORDS:
                    bucket, known = row["bucket"], {}
                found = []
                for word in _unpieced(row["first"]):
                    ids = known.get(word)
                    if ids is None:
                        ids = known[word] = coder.encode_ordinary(word.decode())
                    found.append(ids)
                lengths = np.array([len(found), *map(len, found)], "<u4")
                flat = np.fromiter(chain.from_iterable(found), "<u4", int(lengths[1:].sum()))
                out.append((row["chunk"], bucket, 0, None, None, _squeeze(lengths.tobytes() + flat.tobytes()), row["second"]))
            if out:
                yield _rows(out)

    return encoded


class _Words:
    """The ids of a chunk's words, as they come in from the buckets."""

    def __init__(self):
        self.parts, self.size, self.done = [], 0, None

    def add(self, ids: bytes, steps: bytes) -> None:
        data = np.frombuffer(_widen(ids), "<u4")
        n = int(data[0])
        places = np.cumsum(np.frombuffer(_widen(steps), "<u4").astype(np.int64))
        self.parts.append((places, data[1 : n + 1].astype(np.int64), data[n + 1 :]))
        self.size += n

    def ids(self, positions: np.ndarray) -> np.ndarray:
        if self.done is None:
            sizes, starts, at = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64), 0
            for places, lengths, flat in self.parts:
                sizes[places] = lengths
                starts[places] = at + np.cumsum(lengths) - lengths
                at += len(flat)
            flat = np.concatenate([p[2] for p in self.parts]) if self.parts else np.zeros(0, np.uint32)
            self.done, self.parts = (sizes, starts, flat), []
        sizes, starts, flat = self.done
        if len(positions) and int(positions.max()) >= len(sizes):
            raise RuntimeError("the documents changed between two reads; store them first")
        lengths = sizes[positions]
        shift = starts[positions] - (np.cumsum(lengths) - lengths)
        return flat[np.repeat(shift, lengths) + np.arange(int(lengths.sum()))]


def _assemble(finish):
    def assembled(batches):
        chunk, words = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["chunk"] != chunk:
                    chunk, words = row["chunk"], _Words()
                if row["bucket"] >= 0:
                    words.add(row["first"], row["second"])
                    continue
                positions = _broad(row["first"])
                edges = np.concatenate(([0], np.cumsum(row["sizes"])))
                yield finish(row["doc_ids"], [words.ids(positions[a:b]) for a, b in zip(edges[:-1], edges[1:])])

    return assembled


def _with_ids(doc_ids, lists):
    return pa.RecordBatch.from_arrays(
        [pa.array(doc_ids, pa.int64()), pa.array([x.astype(np.int32) for x in lists], pa.list_(pa.int32()))], names=["doc_id", "ids"]
    )


def _digests(path: str):
    def digested(doc_ids, lists):
        table, names = token_bytes(path)
        rows = []
        for ids in lists:
            ids = ids.tolist()
            rows.append(
                (
                    len(ids),
                    hashlib.sha256(",".join(map(names.__getitem__, ids)).encode()).hexdigest(),
                    hashlib.sha256(b"".join(map(table.__getitem__, ids))).hexdigest(),
                )
            )
        counts, encoded, decoded = zip(*rows) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(doc_ids, pa.int64()), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(decoded, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )

    return digested


_tables: dict[str, tuple[list[bytes], list[str]]] = {}


def token_bytes(path: str) -> tuple[list[bytes], list[str]]:
    """The token-byte table of a vocabulary, by id, and the ids as text; read once a worker."""
    if path not in _tables:
        found = ranks(path)
        table = [b""] * (max(found.values(), default=-1) + 1)
        for token, number in found.items():
            table[number] = token
        _tables[path] = table, [str(i) for i in range(len(table))]
    return _tables[path]


def _joined(docs: DataFrame, path: str, pattern: str, finish, schema: str) -> DataFrame:
    texts = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), PARTS_EACH * texts.rdd.getNumPartitions())
    buckets = BUCKETS_PER_PARTITION * parts
    exploded = texts.mapInArrow(_explode(pattern, buckets), _SHARED)
    # Words go to their bucket, rows of positions anywhere.
    home = F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(F.xxhash64("chunk", "part"))
    encoded = exploded.repartition(parts, home).sortWithinPartitions("bucket").mapInArrow(_encode(path), _SHARED)
    # Word ids come first within a chunk: document rows have part numbers, word rows a bucket.
    order = [F.col("chunk"), (F.col("bucket") < 0).cast("int"), F.col("part")]
    met = encoded.repartition(parts, "chunk").sortWithinPartitions(*order)
    return met.mapInArrow(_assemble(finish), schema)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, ids`` of every document."""
    return _joined(docs, path, pattern, _with_ids, "doc_id bigint, ids array<int>")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """Token count, digest of the ids, and digest of the bytes they decode to, per document."""
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return _joined(docs, path, pattern, _digests(path), schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``doc_id, bytes`` of ``encoded(doc_id, ids)``, by the token-byte table; null ids give null."""

    def decoded(batches):
        table, _ = token_bytes(path)
        for batch in batches:
            texts = [None if ids is None else b"".join(map(table.__getitem__, ids)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").cast(pa.int64()), pa.array(texts, pa.binary())], names=["doc_id", "bytes"])

    return encoded.select("doc_id", "ids").mapInArrow(decoded, "doc_id bigint, bytes binary")
