"""Near-duplicate documents by HyperMinHash.

A document's set is its distinct 5-word shingles (A-Z lowered), as 64-bit hashes; with
one to four words the whole sequence is the one shingle; without words the set is empty
and linked with nothing. Per document:

* HyperMinHash registers: the top bits of a hash choose one of 128 buckets; a bucket keeps
  the leading-zero count and ten mantissa bits of its smallest hash, 16 bits in all. An
  empty bucket borrows from the first filled one of its fixed probe order.
* Banding: 32 bands of four compressed registers. At a similarity of 0.75 a pair meets in
  no band with probability (1 - 0.75^4)^32 = 5e-6, and less above.
* Documents with equal sets are one class; only classes go on.

Candidates are never all pairs of a band bucket. Two rounds pair every member with one
member of its bucket; pairs whose register estimate, corrected for chance collisions of
16-bit registers, is far below the threshold are dropped, and the others are confirmed on
the full sets. Components are formed, and only members of a bucket outside its largest
component are then compared with the rest of it, every one of them: what is already
connected needs no further comparison, so no link that matters for a component is lost.
These comparisons run in blocks inside tasks, each pair in the first bucket it shares, on
the registers and on bitmaps of the sets: a set lacks at least as many shingles of another
as its bitmap lacks bits, which bounds the similarity from above. Only pairs that pass both
are written out and confirmed.

Null texts count as empty. Rows that share a ``doc_id`` share a component. A row without
``doc_id`` is linked with nothing, its component is null and it is kept. Ties go to the
smallest id; an empty table gives an empty result; other columns stay with the caller.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks, mix, stored, word_hashes
from .components import components

SHINGLE = 5
BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
BAND_ROWS = 4
BANDS = BUCKETS // BAND_ROWS
PERCENT = 75

# A pair is confirmed if its estimate is no more than so many deviations below 0.75.
DEVIATIONS = 4.5
ESTIMATE_FLOOR = 0.75 - DEVIATIONS * (0.75 * 0.25 / BUCKETS) ** 0.5

STAR_ROUNDS = 2

BITMAP_BITS = 2048
# Ids of documents that are looked up by broadcast, beyond that by a shuffle: 8 MB at most.
BROADCAST_IDS = 500_000
# Members of a bucket that are compared with each other in one go, and rows of a task's group.
BLOCK = 2_048
CELL_ROWS = 20_000

_PLACE = np.array([mix(np.array([i + 11], np.uint64))[0] | np.uint64(1) for i in range(SHINGLE)])
_PROBES = np.stack([np.concatenate(([j], np.random.default_rng(j).permutation(BUCKETS))) for j in range(BUCKETS)])
_BAND_SALT = mix(np.arange(1, BANDS + 1, dtype=np.uint64))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    for _, data, offsets in blocks(texts):
        words, firsts = word_hashes(data, offsets)
        whole = len(words) - SHINGLE + 1
        runs = np.zeros(max(whole, 0), np.uint64)
        for i in range(SHINGLE):
            runs += words[i : i + len(runs)] * _PLACE[i]
        runs = mix(runs)
        for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
            if b - a >= SHINGLE:
                yield np.unique(runs[a : b - SHINGLE + 1])
            elif b > a:
                yield mix((words[a:b] * _PLACE[: b - a]).sum(keepdims=True) + np.uint64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The HyperMinHash registers of a sorted, non-empty set."""
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    rest = hashes[first] & np.uint64((1 << (64 - BUCKET_BITS)) - 1)
    fraction, exponent = np.frexp(rest.astype(np.float64))
    zeros = 64 - BUCKET_BITS - exponent
    mantissa = np.maximum((fraction * 2 - 1) * (1 << MANTISSA_BITS), 0).astype(np.int64)
    out = np.zeros(BUCKETS, np.uint16)
    out[bucket[first]] = np.minimum(zeros, 62) * (1 << MANTISSA_BITS) + np.minimum(mantissa, 1023) + 1
    if len(first) < BUCKETS:
        filled = out != 0
        empty = np.flatnonzero(~filled)
        probes = _PROBES[empty]
        out[empty] = out[probes[np.arange(len(empty)), filled[probes].argmax(axis=1)]]
    return out


def band_keys(code: np.ndarray) -> np.ndarray:
    packed = np.ascontiguousarray(code).view(np.uint64)
    return mix(packed ^ _BAND_SALT)


def chance(size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Share of registers that agree by chance between disjoint sets of these sizes.

    Registers hold the minimum of about n/BUCKETS uniform values to a relative precision of
    2^-MANTISSA_BITS; two independent minima of rates r and s agree with a probability of
    about 2^-MANTISSA_BITS * r s / (r + s)^2.
    """
    r, s = np.maximum(size_a, 1) / BUCKETS, np.maximum(size_b, 1) / BUCKETS
    return r * s / (r + s) ** 2 / (1 << MANTISSA_BITS)


def estimate(code_a: np.ndarray, code_b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """Collision-corrected Jaccard estimates of rows of registers."""
    agree = (code_a == code_b).mean(axis=1)
    accident = chance(size_a, size_b)
    return (agree - accident) / (1 - accident)


def bitmap(hashes: np.ndarray) -> np.ndarray:
    bits = np.zeros(BITMAP_BITS, bool)
    bits[(mix(hashes ^ _BAND_SALT[1]) & np.uint64(BITMAP_BITS - 1)).astype(np.int64)] = True
    return np.packbits(bits)


_FEATURES = "doc_id bigint, n_shingles bigint, key1 bigint, key2 bigint, registers binary, bits binary"


def _features(batches):
    for batch in batches:
        sizes, keys1, keys2, codes, maps = [], [], [], [], []
        for hashes in shingle_sets(batch.column("text")):
            sizes.append(len(hashes))
            keys1.append(int(mix(hashes).sum(dtype=np.uint64).view(np.int64)) if len(hashes) else 0)
            keys2.append(int(np.bitwise_xor.reduce(mix(hashes ^ _BAND_SALT[0])).view(np.int64)) if len(hashes) else 0)
            codes.append(registers(hashes).tobytes() if len(hashes) else None)
            maps.append(bitmap(hashes).tobytes() if len(hashes) else None)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id").cast(pa.int64()),
                pa.array(sizes, pa.int64()),
                pa.array(keys1, pa.int64()),
                pa.array(keys2, pa.int64()),
                pa.array(codes, pa.binary()),
                pa.array(maps, pa.binary()),
            ],
            names=["doc_id", "n_shingles", "key1", "key2", "registers", "bits"],
        )


def _bands(batches):
    for batch in batches:
        codes = batch.column("registers")
        if not len(codes):
            continue
        keys = np.concatenate([band_keys(np.frombuffer(c.as_py(), np.uint16)) for c in codes])
        ids = np.repeat(batch.column("doc_id").to_numpy(zero_copy_only=False), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids)], names=["band", "doc_id"])


def _sets(batches):
    for batch in batches:
        sets = [hashes.tobytes() for hashes in shingle_sets(batch.column("text"))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(sets, pa.binary())], names=["doc_id", "hashes"]
        )


def _likely(batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = [np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BUCKETS) for c in ("ca", "cb")]
        sizes = [batch.column(c).to_numpy() for c in ("na", "nb")]
        small, large = np.minimum(*sizes), np.maximum(*sizes)
        good = (estimate(*codes, *sizes) >= ESTIMATE_FLOOR) & (100 * small >= PERCENT * large)
        yield batch.select(["a", "b"]).filter(pa.array(good))


def _confirmed(batches):
    for batch in batches:
        good = []
        for one, two in zip(batch.column("sa"), batch.column("sb")):
            left, right = (np.frombuffer(s.as_py(), np.uint64) for s in (one, two))
            shared = len(np.intersect1d(left, right, assume_unique=True))
            good.append(100 * shared >= PERCENT * (len(left) + len(right) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))


class _Side:
    """Rows of one side of a group of blocks, as arrays, by block."""

    def __init__(self, rows: pa.Table):
        rows = rows.combine_chunks()
        get = lambda name: rows.column(name).to_numpy()
        self.place = np.column_stack([get("band"), get("i"), get("j")])
        order = np.lexsort(self.place.T[::-1])
        self.place = self.place[order]
        self.doc, self.comp, self.main, self.n = (get(c)[order] for c in ("doc_id", "comp", "main", "n_shingles"))
        flat = lambda name, kind, width: np.frombuffer(b"".join(rows.column(name).to_pylist()), kind).reshape(-1, width)[order]
        self.code = flat("registers", np.uint16, BUCKETS)
        self.bits = flat("bits", np.uint64, BITMAP_BITS // 64)
        self.keys = mix(np.ascontiguousarray(self.code).view(np.uint64) ^ _BAND_SALT).view(np.int64)

    def groups(self) -> dict[tuple, slice]:
        edges = np.flatnonzero((np.diff(self.place, axis=0) != 0).any(axis=1)) + 1
        edges = [0, *edges.tolist(), len(self.place)] if len(self.place) else [0]
        return {tuple(self.place[a].tolist()): slice(a, b) for a, b in zip(edges[:-1], edges[1:])}


def _compare(movers: pa.Table, members: pa.Table) -> pa.Table:
    """Pairs of different components that may be similar enough, each in its first common bucket."""
    one, two = _Side(movers), _Side(members)
    found_a, found_b = [], []
    places = two.groups()
    for place, rows in one.groups().items():
        there = places.get(place)
        if there is None:
            continue
        first = there.start
        comp, doc, n, main = (x[there] for x in (two.comp, two.doc, two.n, two.main))
        for x in range(rows.start, rows.stop):
            small, large = np.minimum(n, one.n[x]), np.maximum(n, one.n[x])
            good = (comp != one.comp[x]) & ((comp == main) | (doc < one.doc[x])) & (100 * small >= PERCENT * large)
            at = np.flatnonzero(good) + first
            same = two.keys[at] == one.keys[x]
            at = at[two.keys[at, same.argmax(axis=1)] == place[0]]
            at = at[estimate(two.code[at], one.code[x], two.n[at], one.n[x]) >= ESTIMATE_FLOOR]
            if len(at):
                shared = np.minimum(
                    one.n[x] - np.bitwise_count(one.bits[x] & ~two.bits[at]).sum(axis=1, dtype=np.int64),
                    two.n[at] - np.bitwise_count(two.bits[at] & ~one.bits[x]).sum(axis=1, dtype=np.int64),
                )
                at = at[100 * shared >= PERCENT * (one.n[x] + two.n[at] - shared)]
                found_a.append(np.full(len(at), one.doc[x]))
                found_b.append(two.doc[at])
    join = lambda parts: pa.array(np.concatenate(parts) if parts else [], pa.int64())
    return pa.table({"doc_id": join(found_b), "centre": join(found_a)})


class _Search:
    """The candidate rounds over the classes of one corpus."""

    def __init__(self, texts: DataFrame, classes: DataFrame, bands: DataFrame):
        self.texts, self.classes = texts, classes
        self.members = bands
        self.checked = self.links = self.labels = None

    def labelled(self) -> DataFrame:
        """Members of the buckets that hold more than one component, and ``comp``."""
        members = self.members
        if self.labels is None:
            return members.withColumn("comp", F.col("doc_id"))
        labels = self.labels.withColumnRenamed("node", "doc_id")
        members = members.join(labels, "doc_id", "left")
        members = members.withColumn("comp", F.coalesce("component", "doc_id")).drop("component")
        several = members.groupBy("band").agg(F.min("comp").alias("x"), F.max("comp").alias("y"))
        return members.join(several.where("x <> y").select("band"), "band", "left_semi")

    def star(self, number: int) -> DataFrame:
        """Every member with one member of its bucket, the same for all of them."""
        members = self.labelled()
        order = F.struct((F.xxhash64(F.lit(number), "doc_id") if number else F.col("doc_id")).alias("o"), "doc_id", "comp")
        centres = members.groupBy("band").agg(F.min(order).alias("c"))
        centres = centres.select("band", F.col("c.doc_id").alias("centre"), F.col("c.comp").alias("centre_comp"))
        return members.join(centres, "band").where("comp <> centre_comp").select("doc_id", "centre")

    def rest(self) -> DataFrame:
        """Pairs of a bucket in different components that may be similar enough."""
        members = stored(self.labelled(), "neardup-rest")
        sizes = members.groupBy("band", "comp").agg(F.count("*").alias("n"))
        main = sizes.groupBy("band").agg(F.max(F.struct("n", "comp")).alias("m"), F.sum("n").alias("total"))
        blocks = lambda n: F.greatest(F.ceil(n / BLOCK), F.lit(1))
        main = main.select(
            "band",
            F.col("m.comp").alias("main"),
            blocks(F.col("total")).alias("blocks"),
            blocks(F.col("total") - F.col("m.n")).alias("mover_blocks"),
        )
        wide = self.classes.select("doc_id", "n_shingles", "registers", "bits")
        rows = members.join(main, "band").join(wide, "doc_id")
        mine = lambda n: F.pmod(F.xxhash64("doc_id"), F.col(n))
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
        left = rows.where("comp <> main").withColumn("i", mine("mover_blocks")).withColumn("j", every("blocks"))
        right = rows.withColumn("j", mine("blocks")).withColumn("i", every("mover_blocks"))
        cells = max(-(-members.count() // CELL_ROWS), int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        cell = F.pmod(F.xxhash64("band", "i", "j"), F.lit(cells)).alias("cell")
        columns = ["band", "i", "j", "doc_id", "comp", "main", "n_shingles", "registers", "bits"]
        left, right = (side.select(cell, *columns) for side in (left, right))
        right = right.select(*(F.col(c).alias(c) for c in right.columns))
        return left.groupBy(left["cell"]).cogroup(right.groupBy(right["cell"])).applyInArrow(_compare, "doc_id bigint, centre bigint")

    def confirm(self, pairs: DataFrame) -> None:
        """Check pairs that were not checked before, add their links, form components."""
        pairs = pairs.select(F.least("doc_id", "centre").alias("a"), F.greatest("doc_id", "centre").alias("b")).distinct()
        if self.checked is not None:
            pairs = pairs.join(self.checked, ["a", "b"], "left_anti")
        one, two = (
            self.classes.select(
                F.col("doc_id").alias(x), F.col("n_shingles").alias(f"n{x}"), F.col("registers").alias(f"c{x}")
            )
            for x in "ab"
        )
        sized = pairs.join(one, "a").join(two, "b").select("a", "b", "na", "nb", "ca", "cb")
        likely = stored(sized.mapInArrow(_likely, "a bigint, b bigint"), "neardup-pairs")
        # Pairs that the estimate ruled out would be ruled out again.
        self.checked = likely if self.checked is None else self.checked.unionByName(likely)
        needed = likely.select(F.col("a").alias("doc_id")).unionByName(likely.select(F.col("b").alias("doc_id"))).distinct()
        needed = stored(needed, "neardup-needed")
        if needed.count() <= BROADCAST_IDS:
            needed = F.broadcast(needed)
        sets = stored(
            self.texts.join(needed, "doc_id", "left_semi")
            .withColumn("same", F.xxhash64("text"))
            .dropDuplicates(["doc_id", "same"])
            .select("doc_id", "text")
            .mapInArrow(_sets, "doc_id bigint, hashes binary"),
            "neardup-sets",
        )
        one, two = (sets.select(F.col("doc_id").alias(x), F.col("hashes").alias(f"s{x}")) for x in "ab")
        found = stored(
            likely.join(two, "b").join(one, "a").select("a", "b", "sa", "sb").mapInArrow(_confirmed, "a bigint, b bigint"),
            "neardup-links",
        )
        if found.isEmpty():
            return
        self.links = found if self.links is None else self.links.unionByName(found)
        self.labels = components(self.links, "neardup-components")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    features = stored(docs.mapInArrow(_features, _FEATURES), "neardup-features")
    key = ["n_shingles", "key1", "key2"]
    full = features.where("n_shingles > 0 AND doc_id IS NOT NULL")
    least = full.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    reps = least.select(F.col("rep").alias("doc_id"), *key)
    classes = stored(full.join(reps, ["doc_id", *key], "left_semi").dropDuplicates(["doc_id", *key]), "neardup-classes")
    bands = stored(classes.select("doc_id", "registers").mapInArrow(_bands, "band bigint, doc_id bigint"), "neardup-bands")
    shared = bands.groupBy("band").agg(F.min("doc_id").alias("x"), F.max("doc_id").alias("y")).where("x <> y")
    bands = stored(bands.join(shared.select("band"), "band", "left_semi"), "neardup-buckets")

    search = _Search(docs, classes, bands)
    for number in range(STAR_ROUNDS):
        search.confirm(search.star(number))
    search.confirm(search.rest())

    # Rows of one id with different texts are tied together by the id.
    tied = full.join(least, key).where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    twice = full.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    twice = stored(twice, "neardup-twice")
    labels = search.labels
    if not twice.isEmpty():
        tied = tied.join(twice.withColumnRenamed("doc_id", "b"), "b", "left_semi").select("a", "b")
        labels = components(tied if search.links is None else search.links.unionByName(tied), "neardup-components")
    groups = least
    if labels is not None:
        groups = least.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
        groups = groups.withColumn("rep", F.coalesce("component", "rep")).drop("component")
    out = features.drop("registers", "bits").join(groups, key, "left")
    return out.select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("rep", "doc_id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.coalesce("rep", "doc_id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each group: the smallest id, and one row of that id.

    Of rows that repeat an id the one with the smallest hash of its text stays, then of all
    its columns. Rows without an id stay.
    """
    gone = near_duplicates(docs).where("NOT kept").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti")
    twice = docs.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    twice = stored(twice.select("doc_id"), "neardup-repeated")
    repeated = twice.count()
    if not repeated:
        return left
    left = stored(left, "neardup-left")
    if repeated <= BROADCAST_IDS:
        twice = F.broadcast(twice)
    # Folded inside the map tasks first, so an id with many rows is no large group.
    order = F.struct(F.xxhash64("text"), F.xxhash64(*docs.columns))
    rows = left.join(twice, "doc_id", "left_semi").groupBy("doc_id").agg(F.min_by(F.struct(*docs.columns), order).alias("_dl_row"))
    return left.join(twice, "doc_id", "left_anti").unionByName(rows.select("_dl_row.*"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(
    CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w]
    ELSE list_transform(range(1, len(w) - 3), lambda i: w[i:i+4]) END) AS shingle
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)
), e AS (
  SELECT a, b FROM l UNION SELECT b, a FROM l
), r AS (
  SELECT a AS doc_id, a AS reached FROM e UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached
), c AS (
  SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id
)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, w.doc_id) AS component_id,
       coalesce(c.component_id, w.doc_id) = w.doc_id AS kept
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
