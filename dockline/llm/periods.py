"""Periodic runs of words, by internal pattern matching over a suffix array.

A run is a stretch of consecutive words with smallest period q, at least ``exponent`` periods
and ``least`` words long, that no neighbouring word extends with period q kept.

Documents of a batch are put one behind the other, a word of its own between them, and the
suffix array of that text is built by prefix doubling; the ranks of every doubling are kept.
For each dyadic block (2^k words from a multiple of 2^k) the places where the block occurs
again in the window of 2^k starts behind it are asked from a wavelet tree over the suffix
array, by range successor. A run of four periods and more with 2^k <= q < 2^(k+1) has such a
block whose next copy starts q words on, inside that window. The places found form one
progression:
one or two are candidate periods themselves; three or more mean that the block itself has
the progression's step as a period, and then only the shift between the ends of both
stretches with that step can be q. Candidates are extended to both sides with the ranks, and
of equal stretches the smallest period stays.

Words are what lies between blanks and ``\\t\\n\\v\\f\\r``. A null or empty text has no words,
no runs and an empty collapsed text. Rows are worked on one by one: repeated rows and rows
without an id give a row each. Other columns, whatever their names, are not looked at. A text
is worked on whole; a task needs some 200 bytes a word of its longest text. Ties for the run
with the greatest exponent go to the smallest start, then period. An empty table gives none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Documents are put together up to so many words, so the arrays stay in the caches.
GROUP_WORDS = 1 << 17

RUN = "struct<start: bigint, length: bigint, period: bigint>"
SCHEMA = f"doc_id bigint, n_words bigint, runs array<{RUN}>, best {RUN}, collapsed string"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

Rewrite = Callable[[int | None, list[bytes]], list[bytes]]


class Suffixes:
    """Suffix array of a word text, with the ranks of all prefix lengths 2^k.

    ``ranks[k][i]`` is the first slot of the suffixes that begin with the 2^k words at i.
    The text must end with a word that occurs once.
    """

    def __init__(self, text: np.ndarray) -> None:
        n = len(text)
        self.order = np.argsort(text, kind="stable").astype(np.int32)
        ordered = text[self.order]
        fresh = np.r_[True, ordered[1:] != ordered[:-1]]
        rank = np.empty(n, np.int32)
        rank[self.order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
        self.ranks = [rank]
        step = 1
        while True:
            sizes = np.bincount(rank, minlength=n)
            slots = np.flatnonzero(sizes[rank[self.order]] > 1)
            if not len(slots):
                return
            places = self.order[slots].astype(np.int64)
            key = rank[places].astype(np.int64) * (n + 1) + np.where(places + step < n, rank[np.minimum(places + step, n - 1)] + 1, 0)
            by_key = np.argsort(key, kind="stable")
            places, key = places[by_key], key[by_key]
            self.order[slots] = places
            rank = rank.copy()
            rank[places] = np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], slots, 0))
            self.ranks.append(rank)
            step *= 2

    def ahead(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from i and from j on are equal."""
        i, j = i.copy(), j.copy()
        first, last = i.copy(), len(self.order) - 1
        for k in range(len(self.ranks) - 1, -1, -1):
            same = self.ranks[k][np.minimum(i, last)] == self.ranks[k][np.minimum(j, last)]
            i += same << k
            j += same << k
        return i - first

    def behind(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words before i and before j are equal."""
        i, j = i.copy(), j.copy()
        first = i.copy()
        for k in range(len(self.ranks) - 1, -1, -1):
            a, b = i - (1 << k), j - (1 << k)
            same = (a >= 0) & (b >= 0)
            same &= self.ranks[k][np.maximum(a, 0)] == self.ranks[k][np.maximum(b, 0)]
            i -= same << k
            j -= same << k
        return first - i


class WaveletTree:
    """Values by slot; asks for the least value from a bound on within a range of slots."""

    def __init__(self, values: np.ndarray) -> None:
        self.size, self.levels = len(values), []
        for bit in range(max(int(self.size - 1).bit_length(), 1) - 1, -1, -1):
            low = (values >> bit) & 1 == 0
            zeros = np.zeros(self.size + 1, np.int32)
            np.cumsum(low, out=zeros[1:])
            self.levels.append((bit, zeros, int(zeros[-1])))
            values = np.concatenate([values[low], values[~low]])

    def successor(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The least value of at least ``bound`` in slots [low, high), or ``size`` if none."""
        a, b, below = low.astype(np.int64), high.astype(np.int64), np.zeros(len(low), np.int64)
        for bit, zeros, ones_at in self.levels:
            za, zb = zeros[a], zeros[b]
            one = (bound >> bit) & 1 == 1
            below += np.where(one, zb - za, 0)
            a, b = np.where(one, ones_at + a - za, za), np.where(one, ones_at + b - zb, zb)
        found = (below < high - low) & (bound < self.size)
        a, b, rest = low[found].astype(np.int64), high[found].astype(np.int64), below[found]
        value = np.zeros(len(a), np.int64)
        for bit, zeros, ones_at in self.levels:
            za, zb = zeros[a], zeros[b]
            one = rest >= zb - za
            rest = rest - np.where(one, zb - za, 0)
            value |= one.astype(np.int64) << bit
            a, b = np.where(one, ones_at + a - za, za), np.where(one, ones_at + b - zb, zb)
        out = np.full(len(low), self.size, np.int64)
        out[found] = value
        return out


def candidates(text: np.ndarray, suffixes: Suffixes) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods to try, from the next occurrences of every dyadic block."""
    n = len(text)
    again = np.flatnonzero(text[:-1] == text[1:])
    places, periods = [again], [np.ones(len(again), np.int64)]
    tree = WaveletTree(suffixes.order.astype(np.int64)) if len(suffixes.ranks) > 1 else None
    # Beyond the last kept doubling no block occurs twice.
    for k in range(1, len(suffixes.ranks)):
        block, rank = 1 << k, suffixes.ranks[k]
        starts = np.arange(0, n, block)
        sizes = np.bincount(rank, minlength=n)
        starts = starts[sizes[rank[starts]] > 1]
        if not len(starts):
            continue
        low = rank[starts].astype(np.int64)
        high, end = low + sizes[low], starts + 2 * block
        first = tree.successor(low, high, starts + block)
        met = first < end
        starts, low, high, end, first = starts[met], low[met], high[met], end[met], first[met]
        second = tree.successor(low, high, first + 1)
        third = tree.successor(low, high, second + 1)
        few = third >= end
        places += [starts[few], starts[few & (second < end)]]
        periods += [(first - starts)[few], (second - starts)[few & (second < end)]]
        starts, first, step = starts[~few], first[~few], (second - first)[~few]
        here = starts + suffixes.ahead(starts, starts + step)
        there = first + suffixes.ahead(first, first + step)
        shift = there - here
        fit = (shift >= block) & (shift < 2 * block)
        places.append(starts[fit])
        periods.append(shift[fit])
    return np.concatenate(places), np.concatenate(periods)


def runs_of(text: np.ndarray, exponent: int = 4, least: int = 6) -> np.ndarray:
    """Rows ``start, end, period`` of all runs, by start, then period.

    ``text`` holds word numbers; it begins and ends with words that occur once.
    """
    if exponent < 4:
        raise ValueError("blocks find runs of four periods and more")
    suffixes = Suffixes(text)
    place, period = candidates(text, suffixes)
    end = place + period + suffixes.ahead(place, place + period)
    start = place - suffixes.behind(place, place + period)
    fit = end - start >= np.maximum(least, exponent * period)
    found = np.unique(np.stack([start, end, period], 1)[fit], axis=0)
    # Rows are ordered by start, end, period: of one stretch the smallest period is first.
    if len(found):
        found = found[np.r_[True, (found[1:, :2] != found[:-1, :2]).any(1)]]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def best_of(runs: list[tuple[int, int, int]]) -> tuple[int, int, int]:
    """The ``(start, length, period)`` with the greatest exact exponent."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]))


def _grouped(docs: list[list[bytes]]) -> Iterator[tuple[int, int]]:
    """Slices of documents of about ``GROUP_WORDS`` together."""
    first, words = 0, 0
    for i, doc in enumerate(docs):
        if words and words + len(doc) > GROUP_WORDS:
            yield first, i
            first, words = i, 0
        words += len(doc)
    if first < len(docs):
        yield first, len(docs)


def scan(docs: list[list[bytes]], exponent: int, least: int) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs ``(start, length, period)`` and collapsed text of every document, in order."""
    for first, last in _grouped(docs):
        group = docs[first:last]
        numbers: dict[bytes, int] = {}
        lengths = np.array([len(d) for d in group], np.int64)
        # A word of its own stands before every document and at the end.
        starts = np.concatenate([[0], np.cumsum(lengths + 1)]) + 1
        text = np.empty(starts[-1], np.int64)
        for at, doc in zip(starts, group):
            text[at : at + len(doc)] = [numbers.setdefault(w, len(numbers)) for w in doc]
        text[starts - 1] = len(numbers) + np.arange(len(starts))
        found = runs_of(text, exponent, least)
        owner = np.searchsorted(starts, found[:, 0], "right") - 1
        dropped = np.zeros(len(text) + 1, np.int64)
        np.add.at(dropped, found[:, 0] + found[:, 2], 1)
        np.add.at(dropped, found[:, 1], -1)
        kept = np.cumsum(dropped[:-1]) == 0
        by_doc: dict[int, list[tuple[int, int, int]]] = {}
        for i, (start, end, period) in zip(owner.tolist(), found.tolist()):
            by_doc.setdefault(i, []).append((start - int(starts[i]), end - start, period))
        for i, doc in enumerate(group):
            if i in by_doc:
                doc = [doc[j] for j in np.flatnonzero(kept[starts[i] : starts[i] + len(doc)])]
            yield by_doc.get(i, []), b" ".join(doc)


def periodic_runs(docs: DataFrame, exponent: int = 4, least: int = 6, rewrite: Rewrite | None = None) -> DataFrame:
    """Per document: id, number of words, runs, the run of greatest exponent, collapsed text.

    In the collapsed text, words joined by one blank, every run keeps its first period.
    ``rewrite(doc_id, words)`` may replace the words of a document before they are searched.
    """

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            # bytes.split() cuts at exactly the six separators.
            words = [bytes(t).split() if t else [] for t in batch.column(1).to_pylist()]
            if rewrite:
                words = [rewrite(i, w) for i, w in zip(ids, words)]
            runs, best, texts = [], [], []
            for own, text in scan(words, exponent, least):
                named = [dict(zip(("start", "length", "period"), r)) for r in own]
                runs.append(named)
                best.append(dict(zip(("start", "length", "period"), best_of(own))) if own else None)
                texts.append(text)
            yield pa.record_batch(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([len(w) for w in words], pa.int64()),
                    pa.array(runs, pa.list_(_RUN)),
                    pa.array(best, _RUN),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "best", "collapsed"],
            )

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.encode("text", "UTF-8").alias("text"))
    return rows.mapInArrow(search, SCHEMA)


def digests(found: DataFrame) -> DataFrame:
    """Counts, the best run and checksums of what ``periodic_runs`` gives."""
    lines = F.transform("runs", lambda r: F.concat_ws(",", r.start, r.length, r.period))
    sha = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        sha(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), "")).alias("runs_sha256"),
        sha(F.col("collapsed")).alias("collapsed_sha256"),
    )
