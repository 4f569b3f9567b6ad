"""Line dedup by pairwise alignment.

A line here ends at a line break or at the end of a sentence, as corpora often hold a
paragraph in one line and passages are repeated within it. White space around a line does
not count. Two documents overlap if they share a run of lines with at least
``MIN_BLOCK_CHARS`` characters: every line starts one such shortest run, and the hash of
the run links its first holder (the smallest id) with each later one. That is linear in
the occurrences however many documents share a run, so none has to be left out for being
frequent, and lines that are short and common link nothing on their own. The lines of each
such pair are aligned by patience diff: equal heads and tails, then lines that are rare
(single) in both and in the same order, or else equal occurrences of repeated lines, then
the stretches between them. Blocks of aligned lines that hold at least ``MIN_BLOCK_CHARS``
characters are deleted from the later document; what is left of it is aligned again, so a
block that it holds twice goes twice. An alignment takes the most lines, so short shared lines
in order can hide a passage out of order; where it shows no block, the runs shared with the
earlier document are looked up one by one and go as well, until none is left.

A line is deleted only if an earlier document holds it too, so the first copy stays. A
document whose text equals an earlier one's is one block. Ids order documents; of rows
with one id and equal texts all stay as one document, and rows of one id are not compared
with each other. Null and empty texts have no lines and stay as they are; so do rows
without an id. Text is kept byte for byte but for the deleted lines; a line break stays if
something before it in its line does.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from .common import SPACE, mix, stored

# A passage of more than 50 words has more than 100 characters.
MIN_BLOCK_CHARS = 100

# Where lines end: after a line break, a full-width stop, or a stop and a blank, with a closing
# quotation mark or bracket between them or not.
STOPS, CLOSERS, WIDE_STOPS = ".!?\u2026\u0964\u061F\u06D4", "\"'\u201D\u2019\u00BB)\\]", "\u3002\uFF01\uFF1F"
LINE_END = rf"(?<=\n)|(?<=[{STOPS}] )|(?<=[{STOPS}][{CLOSERS}] )|(?<=[{WIDE_STOPS}])"
_LINE_END = re.compile(LINE_END)

_BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest subsequence of pairs that rises in both; they rise in the first."""
    tails: list[int] = []
    ends: list[int] = []
    before = [-1] * len(pairs)
    for at, (_, j) in enumerate(pairs):
        k = bisect_left(tails, j)
        before[at] = ends[k - 1] if k else -1
        tails[k : k + 1] = [j]
        ends[k : k + 1] = [at]
    out, at = [], ends[-1] if ends else -1
    while at >= 0:
        out.append(pairs[at])
        at = before[at]
    return out[::-1]


def _places(lines: list, first: int, last: int) -> dict:
    places: dict = {}
    for at in range(first, last):
        places.setdefault(lines[at], []).append(at)
    return places


def align(left: list, right: list) -> list[tuple[int, int]]:
    """Patience diff: rising pairs ``(i, j)`` with ``left[i] == right[j]``."""
    found: list[tuple[int, int]] = []
    work = [(0, len(left), 0, len(right))]
    while work:
        a, b, c, d = work.pop()
        while a < b and c < d and left[a] == right[c]:
            found.append((a, c))
            a, c = a + 1, c + 1
        while a < b and c < d and left[b - 1] == right[d - 1]:
            b, d = b - 1, d - 1
            found.append((b, d))
        if a == b or c == d:
            continue
        one, two = _places(left, a, b), _places(right, c, d)
        shared = [(one[x], two[x]) for x in one if x in two]
        single = [(i[0], j[0]) for i, j in shared if len(i) == len(j) == 1]
        anchors = _rising(sorted(single or [p for i, j in shared for p in zip(i, j)]))
        for i, j in anchors:
            work.append((a, i, c, j))
            found.append((i, j))
            a, c = i + 1, j + 1
        if anchors:
            work.append((a, b, c, d))
    return sorted(found)


def _runs(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of the second side in which both sides go on line by line."""
    out: list[tuple[int, int]] = []
    for at, (i, j) in enumerate(pairs):
        if at and pairs[at - 1] == (i - 1, j - 1):
            out[-1] = (out[-1][0], j + 1)
        else:
            out.append((j, j + 1))
    return out


def shared_runs(left: np.ndarray, right: np.ndarray, sizes: np.ndarray, least: int = MIN_BLOCK_CHARS) -> list[tuple[int, int]]:
    """Ranges of ``right``, in order, that are the longest runs from their first line that ``left`` holds anywhere."""
    known, first = np.unique(right, return_index=True)
    at = np.minimum(np.searchsorted(known, left), len(known) - 1)
    # A line that only the left side holds ends no shared run, whatever its size.
    left_sizes = np.where(known[at] == left, sizes[first[at]], 0)
    one, (i, _) = run_hashes(left, left_sizes, least), run_edges(left_sizes, least)
    two, (j, ends) = run_hashes(right, sizes, least), run_edges(sizes, least)
    order = np.argsort(one, kind="stable")
    one, i = one[order], i[order]
    low, high = np.searchsorted(one, two), np.searchsorted(one, two, "right")
    out: list[tuple[int, int]] = []
    done = 0
    for k in np.flatnonzero(low < high).tolist():
        if j[k] < done:
            continue
        places, length = i[low[k] : high[k]], int(ends[k] - j[k])
        while j[k] + length < len(right):
            inside = places[places + length < len(left)]
            inside = inside[left[inside + length] == right[j[k] + length]]
            if not len(inside):
                break
            places, length = inside, length + 1
        done = int(j[k]) + length
        out.append((int(j[k]), done))
    return out


def common_blocks(left: list, right: list, sizes: list[int], least: int = MIN_BLOCK_CHARS) -> list[tuple[int, int]]:
    """Ranges of ``right`` that are runs of lines of ``left`` with ``least`` characters or more."""
    out: list[tuple[int, int]] = []
    known = set(left)
    work = [(0, len(right))]
    while work:
        at, end = work.pop()
        if sum(sizes[k] for k in range(at, end) if right[k] in known) < least:
            continue
        runs = [(at + i, at + j) for i, j in _runs(align(left, right[at:end]))]
        blocks = [(i, j) for i, j in runs if sum(sizes[i:j]) >= least]
        out += blocks
        if blocks:
            for i, j in blocks:
                work.append((at, i))
                at = j
            work.append((at, end))
        else:
            arrays = (np.array(x, np.int64) for x in (left, right[at:end], sizes[at:end]))
            out += [(at + i, at + j) for i, j in shared_runs(*arrays, least)]
    return sorted(out)


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def run_edges(sizes: np.ndarray, least: int = MIN_BLOCK_CHARS) -> tuple[np.ndarray, np.ndarray]:
    """First lines and ends of the shortest runs with ``least`` characters, one for each line that starts one."""
    before = np.concatenate([[0], np.cumsum(sizes)])
    starts = np.flatnonzero((before[-1] - before[:-1] >= least) & (sizes > 0))
    return starts, np.searchsorted(before, before[starts] + least)


def run_hashes(hashes: np.ndarray, sizes: np.ndarray, least: int = MIN_BLOCK_CHARS) -> np.ndarray:
    """Hashes of the runs of ``run_edges``."""
    n = len(hashes)
    starts, ends = run_edges(sizes, least)
    # A polynomial of the lines up to each place; differences are brought to the power 0.
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mix(hashes.view(np.uint64)) * _powers(_BASE, n), out=sums[1:])
    length = (ends - starts).astype(np.uint64)
    return mix((sums[ends] - sums[starts]) * _powers(_BASE_INVERSE, n)[starts] + length).view(np.int64)


_KIND = np.zeros(0x110000, np.uint8)
_STOP, _CLOSER, _ENDS, _BLANK = 1, 2, 4, 8
for _chars, _bit in ((STOPS, _STOP), (CLOSERS.replace("\\", ""), _CLOSER), (WIDE_STOPS + "\n", _ENDS), (" \t\n\v\f\r", _BLANK)):
    _KIND[[ord(c) for c in _chars]] |= _bit


def lines_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and sizes of the lines of texts that are not empty, white space around them left out, and where each text's lines begin."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    begins = ends - lengths
    kind = _KIND[codes]
    stop, closer = (kind & _STOP) > 0, (kind & _CLOSER) > 0
    # Whether a sentence is over before each place, in the text it belongs to.
    over = np.zeros(len(codes), bool)
    over[1:] = stop[:-1]
    over[2:] |= closer[1:-1] & stop[:-2] & ~np.isin(np.arange(1, len(codes) - 1), begins)
    over[begins] = False
    cuts = np.flatnonzero(((kind & _ENDS) > 0) | (over & (codes == 0x20))) + 1
    starts = np.concatenate([begins, cuts])
    owner = np.concatenate([np.arange(len(texts)), np.searchsorted(ends, cuts)])
    order = np.lexsort((starts, owner))
    starts, owner = starts[order], owner[order]
    edges = np.searchsorted(owner, np.arange(len(texts) + 1))
    until = np.append(starts[1:], 0)
    until[edges[1:] - 1] = ends
    dark = np.flatnonzero((kind & _BLANK) == 0)
    low, high = np.searchsorted(dark, starts), np.searchsorted(dark, until)
    full = high > low
    a, b = (np.append(dark, 0)[x] for x in (low, high - 1))
    a, b = np.where(full, a, 0), np.where(full, b + 1, 0)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(mix((codes.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE)) * _powers(_BASE, len(codes)), out=sums[1:])
    hashes = mix((sums[b] - sums[a]) * _powers(_BASE_INVERSE, len(codes) + 1)[a] + (b - a).astype(np.uint64))
    return hashes.view(np.int64), b - a, edges


# Texts are cut together up to so many characters.
CUT_CHARS = 1 << 18


def _with_lines(batches):
    for batch in batches:
        texts = batch.column("text").to_pylist()
        parts, first = [], 0
        while first < len(texts):
            last, chars = first, 0
            while last < len(texts) and (last == first or chars + len(texts[last]) <= CUT_CHARS):
                chars += len(texts[last])
                last += 1
            parts.append(lines_of(texts[first:last]))
            first = last
        hashes, sizes, runs = [], [], []
        for own, length, edges in parts:
            for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
                hashes.append(own[a:b])
                sizes.append(length[a:b].astype(np.int32))
                runs.append(np.unique(run_hashes(own[a:b], length[a:b])))
        lists = [pa.array(hashes, pa.list_(pa.int64())), pa.array(sizes, pa.list_(pa.int32())), pa.array(runs, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), *lists], names=["doc_id", "text_key", "hashes", "sizes", "runs"]
        )


def _aligned(batches):
    for batch in batches:
        rows, starts, ends = [], [], []
        for row, lists in enumerate(zip(*(batch.column(c) for c in ("earlier", "later", "sizes")))):
            for first, last in common_blocks(*(x.as_py() for x in lists)):
                rows.append(row)
                starts.append(first)
                ends.append(last)
        named = batch.select(["doc_id", "text_hash"]).take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*named.columns, pa.array(starts, pa.int32()), pa.array(ends, pa.int32())],
            names=["doc_id", "text_hash", "first", "last"],
        )


def repeated_blocks(docs: DataFrame) -> DataFrame:
    """``doc_id, text_hash, blocks`` of documents that repeat earlier ones; blocks are line ranges.

    Null blocks stand for the whole text.
    """
    texts = docs.where("doc_id IS NOT NULL AND text <> ''").select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.struct(F.xxhash64("text").alias("h"), F.crc32(F.encode("text", "UTF-8")).alias("c"), F.length("text").alias("n")).alias("text_key"),
        "text",
    )
    schema = T.StructType([f for f in texts.schema if f.name != "text"])
    for name, kind in (("hashes", T.LongType()), ("sizes", T.IntegerType()), ("runs", T.LongType())):
        schema = schema.add(name, T.ArrayType(kind))
    table = stored(texts.mapInArrow(_with_lines, schema), "lines")
    first_ids = table.groupBy("text_key").agg(F.min("doc_id").alias("first_id"))
    firsts = table.join(first_ids.withColumnRenamed("first_id", "doc_id"), ["doc_id", "text_key"], "left_semi")
    firsts = stored(firsts.dropDuplicates(["doc_id", "text_key"]), "lines-first")
    copies = (
        table.select("doc_id", "text_key")
        .distinct()
        .join(first_ids, "text_key")
        .where(f"doc_id <> first_id AND text_key.n >= {MIN_BLOCK_CHARS}")
        .select("doc_id", "text_key.h", F.lit(None).cast("array<struct<first:int,last:int>>").alias("blocks"))
    )
    holds = firsts.select("doc_id", F.explode("runs").alias("run"))
    holders = holds.groupBy("run").agg(F.min("doc_id").alias("one"), F.max("doc_id").alias("last"))
    pairs = holds.join(holders.where("one <> last").select("run", "one"), "run").where("doc_id <> one")
    pairs = stored(pairs.select("one", "doc_id").distinct(), "lines-pairs")
    later = firsts.select("doc_id", F.col("text_key.h").alias("text_hash"), F.col("hashes").alias("later"), "sizes")
    earlier = firsts.select(F.col("doc_id").alias("one"), F.col("hashes").alias("earlier"))
    both = pairs.join(later, "doc_id").join(earlier, "one")
    found = (
        both.select("doc_id", "text_hash", "earlier", "later", "sizes")
        .mapInArrow(_aligned, "doc_id bigint, text_hash bigint, first int, last int")
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("first", "last")).alias("blocks"))
    )
    return stored(found.union(copies), "lines-blocks")


def without(text: str, blocks: list[tuple[int, int]]) -> tuple[str, int]:
    """``text`` without the lines of the blocks, and how many those are."""
    lines = _LINE_END.split(text)
    gone = np.zeros(len(lines), bool)
    for first, last in blocks:
        gone[first:last] = True
    kept: list[str] = []
    for line, out in zip(lines, gone.tolist()):
        if not out:
            kept.append(line)
        elif line.endswith("\n") and kept and not kept[-1].endswith("\n"):
            kept.append("\n")
    return "".join(kept), int(gone.sum())


@pandas_udf(T.StructType().add("text", T.StringType()).add("removed", T.IntegerType()))
def _left_over(texts: pd.Series, blocks: pd.Series) -> pd.DataFrame:
    rows = []
    for text, ranges in zip(texts, blocks):
        if text is None:
            rows.append((None, 0))
        elif ranges is None:
            rows.append(("", len(_LINE_END.split(text))))
        else:
            rows.append(without(text, [(r["first"], r["last"]) for r in ranges]))
    return pd.DataFrame(rows, columns=["text", "removed"])


def _cut(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_dl_text``, ``_dl_removed`` and ``_dl_emptied``."""
    found = repeated_blocks(docs)
    found = found.select(*(F.col(c).alias(f"_dl_{c}") for c in found.columns), F.lit(True).alias("_dl_found"))
    own = (F.col("doc_id").cast("bigint") == F.col("_dl_doc_id")) & (F.xxhash64("text") == F.col("_dl_text_hash"))
    # The table of blocks grows with the corpus: never broadcast, whatever its size just now.
    joined = docs.join(found.hint("merge"), own, "left")
    # Only texts with blocks go to Python.
    joined = joined.withColumn("_dl_left", _left_over(F.when(F.col("_dl_found"), F.col("text")), F.col("_dl_blocks")))
    text = F.when(F.col("_dl_found"), F.col("_dl_left.text")).otherwise(F.col("text"))
    return joined.withColumn("_dl_text", text).withColumns(
        {
            "_dl_removed": F.col("_dl_left.removed"),
            "_dl_emptied": F.col("_dl_found").isNotNull() & (F.trim(F.regexp_replace("_dl_text", SPACE, " ")) == ""),
        }
    )


def _restored(columns: list[str]) -> list[Column]:
    """The columns of documents; a cut text counts its characters anew."""
    new = {"text": F.col("_dl_text")}
    if "n_chars" in columns:
        new["n_chars"] = F.when(F.col("_dl_found"), F.length("_dl_text")).otherwise(F.col("n_chars"))
    return [new[c].alias(c) if c in new else F.col(c) for c in columns]


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` cut, and ``lines_removed``, ``emptied`` in place of such columns.

    ``emptied`` marks documents of which nothing but white space is left.
    """
    cut = _cut(docs)
    columns = [c for c in docs.columns if c not in ("lines_removed", "emptied")]
    return cut.select(
        *_restored(columns), F.col("_dl_removed").alias("lines_removed"), F.col("_dl_emptied").alias("emptied")
    )


def drop_repeated_lines(docs: DataFrame) -> DataFrame:
    """``docs`` without repeated blocks; documents that consisted of nothing else go."""
    cut = _cut(docs).where("NOT _dl_emptied")
    return cut.select(*_restored(docs.columns))
