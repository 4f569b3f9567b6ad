"""Packing by order-preserving dynamic programming.

The documents of a partition form one stream of token ids, each document followed by an
end id. The stream is cut into windows of at most ``length`` ids. Cuts are allowed at the
ends of documents (free), at the ends of sentences (a small penalty) and on a grid of
positions inside long ones (a large penalty). Dynamic programming finds the cuts with the
least padding plus penalties: the cost up to cut k is the least of
``cost(j) + length - (k - j) + penalty(k)`` over the cuts j within ``length``; as the part
that depends on j is ``cost(j) + j``, its sliding minimum is kept in a monotone queue and
every cut is pushed and popped once.

The stream is worked off in segments; the last window of a segment is not closed but
carried over, so memory is bounded by a segment and one document. Nothing is shuffled: the
order of the rows is kept and sequences are numbered within their partition.

Null and empty texts are the end id alone. Rows are never merged, whatever their ids. An
empty table gives no sequences. Token ids are those of the tokenizer file, without special
tokens added; its special tokens' strings are matched in texts as that library does.
"""

from __future__ import annotations

import json
import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

LENGTH = 1024
END_ID = 0
# Penalties, in tokens of padding.
SENTENCE_PENALTY = 4
HARD_PENALTY = 64
GRID = 128
SEGMENT = 1 << 18

_encoders: dict[str, "Encoder"] = {}


def byte_letters() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: visible ones as themselves."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Encoder:
    """A byte-level BPE tokenizer file, read once a worker."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        special = {t["content"]: t["id"] for t in file["added_tokens"]}
        letters = byte_letters()
        self.tokens = {
            bytes(letters[c] for c in token): number
            for token, number in file["model"]["vocab"].items()
            if token not in special
        }
        self.path, self.slow = path, None
        self.fast = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=self.tokens, special_tokens=special)
        size = max(max(self.tokens.values()), max(special.values(), default=0)) + 1
        self.ends = np.zeros(size, bool)
        for token, number in self.tokens.items():
            self.ends[number] = token.rstrip(b" ")[-1:] in (b".", b"!", b"?", b"\n")

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        try:
            return self.fast.encode_to_numpy(text, allowed_special="all")
        except ValueError:
            # The pattern matcher gives up on runs of millions of blanks.
            if self.slow is None:
                from tokenizers import Tokenizer

                self.slow = Tokenizer.from_file(self.path)
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, np.uint32)


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def best_cuts(places: list[int], penalties: list[int], length: int) -> list[int]:
    """The places of the cheapest cuts, from the first place to the last, both included."""
    keys, back = [0] * len(places), [0] * len(places)
    queue = deque([0])
    for k in range(1, len(places)):
        least = places[k] - length
        while places[queue[0]] < least:
            queue.popleft()
        back[k] = queue[0]
        keys[k] = key = keys[queue[0]] + length + penalties[k]
        while queue and keys[queue[-1]] >= key:
            queue.pop()
        queue.append(k)
    cuts, k = [], len(places) - 1
    while k:
        cuts.append(places[k])
        k = back[k]
    return [places[0], *reversed(cuts)]


def candidate_cuts(ids: np.ndarray, ends: np.ndarray, document_ends: np.ndarray) -> tuple[list[int], list[int]]:
    """Places where a window may end, and what a cut there costs."""
    penalty = np.full(len(ids) + 1, -1, np.int64)
    penalty[::GRID] = HARD_PENALTY
    penalty[1:][ends[ids]] = SENTENCE_PENALTY
    penalty[document_ends] = 0
    penalty[0] = penalty[-1] = 0
    places = np.flatnonzero(penalty >= 0)
    return places.tolist(), penalty[places].tolist()


class Packer:
    """The stream of one partition."""

    def __init__(self, coder: Encoder, length: int, first: int, with_ids: bool):
        self.coder, self.length, self.sequence, self.with_ids = coder, length, first, with_ids
        self.parts: list[np.ndarray] = []
        self.size = 0
        # Of the documents in the segment: id, where it starts (below 0: before), its tokens.
        self.documents: list[tuple[int | None, int, int]] = []

    def add(self, doc_id: int | None, text: str | None) -> None:
        ids = np.append(self.coder.encode(text), np.uint32(END_ID))
        self.documents.append((doc_id, self.size, len(ids)))
        self.parts.append(ids)
        self.size += len(ids)

    def close(self, last: bool) -> dict[str, list]:
        """Cut the segment; unless ``last``, the last window stays open."""
        out: dict[str, list] = {name: [] for name in COLUMNS}
        if not self.size:
            return out
        ids = np.concatenate(self.parts)
        starts = np.array([start for _, start, _ in self.documents])
        ends = starts + np.array([tokens for _, _, tokens in self.documents])
        cuts = best_cuts(*candidate_cuts(ids, self.coder.ends, ends), self.length)
        if not last:
            cuts.pop()
        stop = cuts[-1]
        edges = np.union1d(cuts, starts[(starts > 0) & (starts < stop)])
        begins, finishes = edges[:-1], edges[1:]
        holder = np.searchsorted(starts, begins, "right") - 1
        window = np.searchsorted(cuts, begins, "right") - 1
        little = ids.astype("<u4", copy=False)
        for a, b, d, w in zip(begins.tolist(), finishes.tolist(), holder.tolist(), window.tolist()):
            doc_id, start, tokens = self.documents[d]
            piece = little[a:b]
            out["doc_id"].append(doc_id)
            out["start"].append(a - start)
            out["length"].append(b - a)
            out["ids_crc32"].append(zlib.crc32(piece.tobytes()))
            out["doc_tokens"].append(tokens)
            out["sequence_id"].append(self.sequence + w)
            out["offset"].append(a - cuts[w])
            if self.with_ids:
                out["ids"].append(piece.astype(np.int32))
        self.sequence += len(cuts) - 1
        self.documents = [(i, s - stop, n) for i, s, n in self.documents if s + n > stop]
        self.parts, self.size = [ids[stop:]], len(ids) - stop
        return out


COLUMNS = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")
SCHEMA = ", ".join(f"{name} bigint" for name in COLUMNS[:-1])


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: where it starts, its sequence and its offset there.

    ``with_ids`` adds the piece's token ids, so that the sequences can be written as they are.
    """

    def packed(batches):
        packer = Packer(encoder(vocabulary), length, TaskContext.get().partitionId() << 40, with_ids)

        def rows(out):
            names = COLUMNS if with_ids else COLUMNS[:-1]
            kinds = [pa.int64()] * (len(COLUMNS) - 1) + [pa.list_(pa.int32())]
            return pa.RecordBatch.from_arrays([pa.array(out[n], k) for n, k in zip(names, kinds)], names=list(names))

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                packer.add(doc_id, text.as_py())
                if packer.size >= SEGMENT:
                    yield rows(packer.close(last=False))
        yield rows(packer.close(last=True))

    schema = SCHEMA + (", ids array<int>" if with_ids else "")
    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(packed, schema)
