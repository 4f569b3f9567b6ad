"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds, for every place i, the hash of its first i code points as a
polynomial modulo a prime. The hash of any span is the difference of two entries, divided by
the base's power at its start, so equal spans have equal hashes wherever they stand.

A fingerprint is a sample of that array: length, the hash of the whole text by two primes,
entries at evenly spaced places from either end (at most 32, the step a power of two), and
entries at places chosen by content (at most 64): where the hash of the next 16 code points
ends in enough zero bits. Two fingerprints answer, for spans between sampled places, whether
they are equal. Their likeness is found from the longest common extensions of both starts and
of both ends, by binary search over places sampled in both, and from the spans between content
places in the middle that occur in both: twice the code points in common by those of both
texts. It is 1 for equal fingerprints and two empty texts, 0 if just one text is empty. It
misses up to one span at each side of a difference.

Equal texts have equal fingerprints, null counts as empty. Texts count whole; a text takes
some 60 bytes of a task for each code point. The document that follows in descending order
of ``doc_id`` is found by dealing the rows out in ranges of ids, each with a copy of the first
row of the next range; an id that many rows share is spread by the hash of their texts. Rows
that repeat an id follow by that hash, rows without one come last; every row gives a row. One
row alone follows itself, an empty table gives an empty result. Other columns are not looked
at, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import mix

# Two primes below 2^31, so products fit 64 bits, and a base for each.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_299_709, 15_485_863)
WINDOW = 16
GRID = 32
CUTS = 64
# Texts are hashed together up to so many code points.
BLOCK_CHARS = 1 << 20
# Ranges of ids for each partition of the shuffle.
RANGES_EACH = 8

_HEAD = np.dtype([("chars", "<u8"), ("whole", "<u4", 2), ("grid", "u1")])
_CUT = np.dtype([("place", "<u4"), ("value", "<u4"), ("level", "u1")])
SCHEMA = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string,"
    " near_edited double, near_next double"
)


class Powers:
    """Powers of a base modulo a prime, and of its inverse, as far as they are needed."""

    def __init__(self, base: int, prime: int) -> None:
        self.prime = np.uint64(prime)
        self.up, self.down = (self._first(x) for x in (base, pow(base, -1, prime)))

    def _first(self, base: int) -> np.ndarray:
        return np.array([1, base], np.uint64)

    def reach(self, count: int) -> None:
        while len(self.up) < count:
            self.up, self.down = (np.concatenate([x, x * (x[-1] * x[1] % self.prime) % self.prime]) for x in (self.up, self.down))


_POWERS = [Powers(b, p) for b, p in zip(BASES, PRIMES)]


@dataclass
class Marks:
    """A fingerprint taken apart: hashes of even prefixes and suffixes, and the chosen cuts."""

    chars: int
    whole: tuple[int, int]
    values: np.ndarray
    ends: np.ndarray
    cuts: np.ndarray

    def text(self) -> str:
        head = np.zeros(1, _HEAD)
        head["chars"], head["whole"][0], head["grid"] = self.chars, self.whole, len(self.values)
        even = np.concatenate([self.values, self.ends]).astype("<u4")
        return base64.b64encode(head.tobytes() + even.tobytes() + self.cuts.tobytes()).decode()


def parse(fingerprint: str) -> Marks:
    data = base64.b64decode(fingerprint)
    head = np.frombuffer(data, _HEAD, 1)[0]
    chars, grid = int(head["chars"]), int(head["grid"])
    values = np.frombuffer(data, "<u4", 2 * grid, _HEAD.itemsize)
    cuts = np.frombuffer(data, _CUT, offset=_HEAD.itemsize + 8 * grid)
    return Marks(chars, tuple(map(int, head["whole"])), values[:grid], values[grid:], cuts)


def grid_places(chars: int) -> np.ndarray:
    step = 1
    while chars // step > GRID:
        step *= 2
    return np.arange(step, chars + 1, step)


class Prefixes:
    """Prefix arrays of texts put one behind the other."""

    def __init__(self, codes: np.ndarray, prime: int = 0) -> None:
        self.powers = _POWERS[prime]
        self.powers.reach(len(codes) + 1)
        p = self.powers.prime
        self.sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum((codes.astype(np.uint64) + np.uint64(1)) * self.powers.up[: len(codes)] % p, out=self.sums[1:])
        self.sums %= p

    def span(self, first: np.ndarray | int, last: np.ndarray | int) -> np.ndarray:
        """Hashes of the spans [first, last)."""
        p = self.powers.prime
        return (self.sums[last] + p - self.sums[first]) * self.powers.down[first] % p


def marks_of(texts: list[str]) -> list[Marks]:
    """The fingerprint of every text, taken apart."""
    out: list[Marks] = []
    first = 0
    while first < len(texts):
        last, chars = first, 0
        while last < len(texts) and (last == first or chars + len(texts[last]) <= BLOCK_CHARS):
            chars += len(texts[last])
            last += 1
        out += _block_marks(texts[first:last])
        first = last
    return out


def _block_marks(texts: list[str]) -> list[Marks]:
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    ends = np.cumsum([len(t) for t in texts], dtype=np.int64)
    one, two = Prefixes(codes), Prefixes(codes, 1)
    windows = np.arange(max(len(codes) - WINDOW + 1, 0))
    spread = mix(one.span(windows, windows + WINDOW) + np.uint64(1))
    # Zero bits at the end: the float of a power of two is exact.
    levels = np.log2((spread & (~spread + np.uint64(1))).astype(np.float64)).astype(np.int64)
    out = []
    for start, end in zip((ends - [len(t) for t in texts]).tolist(), ends.tolist()):
        chars = end - start
        grid = grid_places(chars)
        own = levels[start : max(end - WINDOW + 1, start)]
        # The lowest level that few enough places reach.
        reach = np.cumsum(np.bincount(own, minlength=65)[::-1])[::-1]
        level = int(np.argmax(reach <= CUTS))
        at = np.flatnonzero(own >= level)
        cuts = np.zeros(len(at), _CUT)
        cuts["place"], cuts["value"], cuts["level"] = at, one.span(start, start + at), own[at]
        whole = (int(one.span(start, end)), int(two.span(start, end)))
        out.append(Marks(chars, whole, one.span(start, start + grid), one.span(end - grid, end), cuts))
    return out


def _to_end(m: Marks) -> np.ndarray:
    """Hashes of the spans from every cut to the end."""
    powers = _POWERS[0]
    powers.reach(m.chars + 1)
    values = m.cuts["value"].astype(np.uint64)
    return (np.uint64(m.whole[0]) + powers.prime - values) * powers.down[m.cuts["place"]] % powers.prime


def _spans(m: Marks, level: int, first: int, last: int) -> Counter:
    """Spans between cuts of at least ``level`` inside [first, last), by length and hash."""
    cuts = m.cuts[(m.cuts["level"] >= level) & (m.cuts["place"] >= first) & (m.cuts["place"] <= last)]
    powers = _POWERS[0]
    places, values = cuts["place"].astype(np.int64), cuts["value"].astype(np.uint64)
    hashes = (values[1:] + powers.prime - values[:-1]) * powers.down[places[:-1]] % powers.prime
    return Counter(zip(np.diff(places).tolist(), hashes.tolist()))


def _extension(a: dict[int, int], b: dict[int, int]) -> int:
    """The longest sampled length at which both tables of hashes agree: once they differ they stay so."""
    both = sorted(a.keys() & b.keys())
    low, high = 0, len(both)
    while low < high:
        middle = (low + high) // 2
        if a[both[middle]] == b[both[middle]]:
            low = middle + 1
        else:
            high = middle
    return both[low - 1] if low else 0


def alike(a: Marks, b: Marks) -> float:
    """The likeness of two fingerprints, from 0 to 1."""
    if (a.chars, a.whole) == (b.chars, b.whole):
        return 1.0
    if not a.chars or not b.chars:
        return 0.0
    heads, tails = [], []
    for m in (a, b):
        grid, whole = grid_places(m.chars).tolist(), {m.chars: m.whole[0]}
        places = m.cuts["place"].astype(np.int64)
        heads.append(dict(zip(grid, m.values.tolist())) | dict(zip(places.tolist(), m.cuts["value"].tolist())) | whole)
        tails.append(dict(zip(grid, m.ends.tolist())) | dict(zip((m.chars - places).tolist(), _to_end(m).tolist())) | whole)
    front = _extension(*heads)
    back = min(_extension(*tails), min(a.chars, b.chars) - front)
    # A text that keeps few cuts keeps them from a higher level on.
    level = max(int(m.cuts["level"].min()) if len(m.cuts) else 0 for m in (a, b))
    shared = _spans(a, level, front, a.chars - back) & _spans(b, level, front, b.chars - back)
    common = front + back + sum(length * count for (length, _), count in shared.items())
    return min(1.0, 2 * common / (a.chars + b.chars))


def likeness(a: str, b: str) -> float:
    """The likeness of two fingerprints as they are stored."""
    return alike(parse(a), parse(b))


def near(a: Column, b: Column) -> Column:
    """The likeness of two fingerprint columns; null if one is."""

    @pandas_udf("double")
    def compare(left: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([likeness(x, y) if x is not None and y is not None else None for x, y in zip(left, right)], dtype="float64")

    return compare(a, b)


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column."""

    @pandas_udf("string")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([m.text() for m in marks_of([t or "" for t in texts])])

    return of(text)


def in_order(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, span, copy)``: ids descending within a span, then the row that follows it as a copy.

    A span's rows stand together in one partition, in order. Spans hold about as many rows each.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
    spans = RANGES_EACH * parts
    shares = F.lit([(i + 1) / spans for i in range(spans - 1)])
    found = rows.select("doc_id").agg(F.percentile_approx("doc_id", shares, 20 * spans)).first()[0]
    bounds = np.array(found or [], np.int64)

    @pandas_udf("int")
    def span_of(ids: pd.Series, ties: pd.Series) -> pd.Series:
        share = ties.to_numpy(np.int64).astype(np.float64) / 2.0**64 + 0.5
        none = ids.isna().to_numpy()
        own = ids.fillna(0).to_numpy(np.int64)
        low, high = np.searchsorted(bounds, own, "left"), np.searchsorted(bounds, own, "right")
        # An id that is a bound itself may fill several spans; ids that are null lie below all.
        inside = low + np.minimum((share * (high - low + 1)).astype(np.int64), high - low)
        below = np.minimum((share * spans).astype(np.int64), spans - 1) - spans
        return pd.Series(np.where(none, below, inside).astype(np.int32))

    placed = rows.withColumn("span", span_of("doc_id", "tie"))
    # One row for each span reaches the driver, and goes back.
    held = sorted(map(tuple, placed.groupBy("span").agg(F.max("doc_id").alias("head")).collect()), key=lambda r: r[0])
    if not held:
        return placed.select("doc_id", "text", "span", F.lit(False).alias("copy"), "tie")
    before = {span: held[(i + 1) % len(held)][0] for i, (span, _) in enumerate(held)}
    heads = spark.createDataFrame([(s, i, before[s]) for s, i in held], "span int, head bigint, before int")
    first = (
        placed.join(F.broadcast(heads), "span")
        .where(F.col("doc_id").eqNullSafe(F.col("head")))
        .groupBy("before")
        .agg(F.max(F.struct("tie", "text")).alias("row"))
        .select(F.lit(None).cast("bigint").alias("doc_id"), "row.text", F.col("before").alias("span"), F.lit(True).alias("copy"), "row.tie")
    )
    every = placed.select("doc_id", "text", "span", F.lit(False).alias("copy"), "tie").unionByName(first)
    return every.repartition(parts, "span").sortWithinPartitions("span", "copy", F.desc_nulls_last("doc_id"), F.desc("tie"))


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the start of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likeness; see ``SCHEMA``."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple | None = None
        for batch in batches:
            ids, texts, copies = (batch.column(i).to_pylist() for i in (0, 1, 3))
            spans = batch.column(2).to_pylist()
            rows = list(zip(ids, texts, spans, copies, marks_of(texts)))
            if last:
                rows.insert(0, last)
            last = rows[-1]
            # The row behind a span's last one is that span's copy.
            pairs = [(x, y) for x, y in zip(rows, rows[1:]) if not x[3]]
            changed = [edited(x[1], y[1]) for x, y in pairs]
            out = [
                (
                    x[0], x[4].chars, hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
                    x[4].text(), m.text(), alike(x[4], m), alike(x[4], y[4]),
                )
                for (x, y), text, m in zip(pairs, changed, marks_of(changed))
            ]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            columns = zip(*out) if out else [[]] * len(kinds)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], [c.split()[0] for c in SCHEMA.split(",")])

    return in_order(docs).select("doc_id", "text", "span", "copy").mapInArrow(compare, SCHEMA)
