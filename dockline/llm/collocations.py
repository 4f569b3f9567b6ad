"""Phrase collocations from a weighted de Bruijn graph of words.

Nodes are phrases of three words, edges phrases of four; an edge's weight is how often it
occurs. Every occurrence of a word gives one row: the phrase of up to four words that starts
there within its piece. Rows of four words are edges; shorter rows are the ends of pieces, and
correct the flow: a phrase of three words occurs as often as the edges that leave it plus the
pieces that end with it, a phrase of two as often as the phrases of three that go on from it
plus the pieces that end with it. So only the longest phrases are shuffled, summed up in every
batch before, and the shorter counts follow where the edges already are. Single words are
counted in the pass before, so the rows of last words are left out.

Two things are learnt in a pass before, and change the work but no result:

- Words seen less than ``least`` times are in no phrase that is looked for, so pieces end at
  them as well. The others are told by a filter of fixed size; words it takes for frequent by
  mistake cost rows only.
- Edges are dealt out by their first two words. Buckets of pairs with too many rows are dealt
  by the whole edge instead, their counts are then summed in a second, small shuffle. A pair
  or a passage may hold any share of the rows.

Unary paths are compacted: a node with one edge in and one out, all of the same weight, lies
inside a longer path wherever it occurs and is not scored. Texts are cut at
``[.,;:!?\\n-\\r]`` into pieces, these at blanks and tabs into words; A-Z become lower case.
Null and empty texts have no words; a null language is ``und``. Rows that repeat count as
often as they stand there; ids and other columns are not looked at. Texts count whole; a
batch of texts needs some 60 bytes of a task for each of its bytes. Ties are settled by count,
then by the phrase's bytes. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import buffers, mix, stored

LONGEST = 4
# Words known as frequent are marked in a filter of so many bits, by two hashes.
FILTER_BITS = 1 << 25
# The edges take several times the space of the texts they come from.
PARTS_EACH = 4
# Pairs are counted in at least so many buckets, and in so many for each partition.
PAIR_BUCKETS = 1 << 13
BUCKETS_EACH = 16
# A bucket is dealt by whole edges if it holds more than this share of a partition.
HOT_SHARE = 0.5
SCALE = 2_000_000

_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_NEXT = np.uint64(0x9E3779B97F4A7C15)


class Words:
    """The words of a batch: bytes, row, language, piece and a 64-bit hash of each."""

    def __init__(self, langs: pa.Array, texts: pa.Array) -> None:
        data, offsets = buffers(texts)
        data = _LOWER[data]
        kind = _KIND[data]
        inside = kind == 0
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last[:-1] &= ~inside[1:] | edge[1:-1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.count = len(starts)
        bounds = np.zeros(self.count + 1, np.int32)
        np.cumsum(ends - starts, out=bounds[1:])
        joined = np.ascontiguousarray(data[inside])
        words = pa.StringArray.from_buffers(self.count, pa.py_buffer(bounds), pa.py_buffer(joined))
        self.rows = np.searchsorted(offsets, starts, "right") - 1
        breaks = np.concatenate([[0], np.cumsum(kind == 2)])[starts] if self.count else starts
        self.opens = np.ones(self.count, bool)
        self.opens[1:] = (np.diff(breaks) != 0) | (np.diff(self.rows) != 0)
        coded = words.dictionary_encode()
        self.words, self.codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        named = langs.fill_null("und").dictionary_encode()
        self.langs, row_langs = named.dictionary, named.indices.to_numpy(zero_copy_only=False)
        self.lang_codes = row_langs[self.rows]
        own = np.array([hash_word(w) for w in self.words.to_pylist()], np.uint64)
        of_lang = np.array([hash_word(w) for w in self.langs.to_pylist()], np.uint64)
        self.hashes = combine(of_lang[self.lang_codes], own[self.codes]) if self.count else np.zeros(0, np.uint64)

    def pair_buckets(self, buckets: int) -> np.ndarray:
        """The bucket of every word and its successor in the piece, or of the word alone."""
        after = np.zeros(self.count, np.uint64)
        after[:-1] = np.where(self.opens[1:], np.uint64(0), self.hashes[1:])
        return (combine(self.hashes, after) % np.uint64(buckets)).astype(np.int32)


def hash_word(word: str) -> int:
    return xxhash.xxh64_intdigest(word.encode())


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * _NEXT + b)


def filter_places(hashes: np.ndarray, bits: int) -> list[np.ndarray]:
    """The two bits of every hash in a filter of so many."""
    return [(hashes >> np.uint64(shift)) % np.uint64(bits) for shift in (0, 32)]


def _survey(docs: DataFrame, buckets: int) -> DataFrame:
    """Counts of ``(lang, word)``, with the word null of all words of a language, and with a bucket of its pairs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        load = np.zeros(buckets, np.int64)
        names = ["lang", "word", "bucket", "count"]
        for batch in batches:
            w = Words(batch.column(0), batch.column(1))
            if not w.count:
                continue
            load += np.bincount(w.pair_buckets(buckets), minlength=buckets)
            key, counts = np.unique(w.lang_codes.astype(np.int64) << 32 | w.codes, return_counts=True)
            langs = w.langs.take(pa.array(key >> 32))
            none = pa.nulls(len(key), pa.int32())
            yield pa.record_batch([langs, w.words.take(pa.array(key & 0xFFFFFFFF)), none, pa.array(counts)], names)
            each = np.bincount(w.lang_codes, minlength=len(w.langs))
            some = [w.langs, pa.nulls(len(each), pa.string()), pa.nulls(len(each), pa.int32()), pa.array(each)]
            yield pa.record_batch(some, names)
        held = np.flatnonzero(load)
        none = pa.nulls(len(held), pa.string())
        yield pa.record_batch([none, none, pa.array(held.astype(np.int32)), pa.array(load[held])], names)

    counted = docs.mapInArrow(count, "lang string, word string, bucket int, count bigint")
    return counted.groupBy("lang", "word", "bucket").agg(F.sum("count").alias("count"))


def _frequent_filter(words: DataFrame, bits: int) -> np.ndarray:
    """The filter as bits. What comes to the driver are its set bytes, as many as it has at most."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = np.array([hash_word(w) for w in batch.column(1).to_pylist()], np.uint64)
            of_lang = np.array([hash_word(w) for w in batch.column(0).to_pylist()], np.uint64)
            at = np.concatenate(filter_places(combine(of_lang, own), bits))
            yield pa.record_batch([pa.array((at >> np.uint64(3)).astype(np.int32)), pa.array((1 << (at & np.uint64(7))).astype(np.int32))], ["byte", "bit"])

    marked = words.select("lang", "word").mapInArrow(places, "byte int, bit int")
    found = marked.groupBy("byte").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits >> 3, np.uint8)
    out[found["byte"].to_numpy()] = found["bits"].to_numpy()
    return out


def _rows(docs: DataFrame, known: np.ndarray, hot: np.ndarray, buckets: int) -> DataFrame:
    """``(deal, lang, k, gram, count)``: the longest phrase of 2 words or more from every frequent word on."""
    shared = docs.sparkSession.sparkContext.broadcast((known, hot))

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, hot = shared.value
        for batch in batches:
            w = Words(batch.column(0), batch.column(1))
            if not w.count:
                continue
            frequent = np.ones(w.count, bool)
            for at in filter_places(w.hashes, 8 * len(known)):
                frequent &= (known[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
            opens = w.opens | ~frequent
            opens[1:] |= ~frequent[:-1]
            first = np.flatnonzero(opens)
            lengths = np.diff(np.append(first, w.count))
            left = np.repeat(first + lengths, lengths) - np.arange(w.count)
            deal = w.pair_buckets(buckets)
            is_hot = hot[deal]
            found = []
            for k in range(2, LONGEST + 1):
                at = np.flatnonzero(frequent & (left == k if k < LONGEST else left >= k))
                parts = [w.words.take(pa.array(w.codes[at + j])) for j in range(k)]
                gram = pc.binary_join_element_wise(*parts, " ")
                whole = w.hashes[at]
                for j in range(1, k):
                    whole = combine(whole, w.hashes[at + j])
                spread = -1 - (whole % np.uint64(buckets)).astype(np.int32)
                columns = [np.where(is_hot[at], spread, deal[at]), w.lang_codes[at].astype(np.int32), np.full(len(at), k, np.int8)]
                found.append(pa.table([*map(pa.array, columns), gram], ["deal", "lang", "k", "gram"]))
            rows = pa.concat_tables(found).group_by(["deal", "lang", "k", "gram"]).aggregate([([], "count_all")])
            rows = rows.set_column(1, "lang", w.langs.take(rows["lang"]))
            yield from rows.rename_columns(["deal", "lang", "k", "gram", "count"]).combine_chunks().to_batches()

    return docs.mapInArrow(longest, "deal int, lang string, k tinyint, gram string, count bigint")


def head(gram: Column | str, words: int | Column) -> Column:
    """So many words from the front, or from the back if negative."""
    return F.call_function("substring_index", F.col(gram) if isinstance(gram, str) else gram, F.lit(" "), F.lit(words) if isinstance(words, int) else words)


def phrase_counts(docs: DataFrame, least: int = 30, filter_bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """``(lang, k, gram, count)`` of all phrases of up to four words seen ``least`` times, and ``(lang, n)``.

    Both are stored tables; the first has the counts of all occurrences within pieces.
    """
    spark = docs.sparkSession
    texts = docs.select("lang", "text")
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), PARTS_EACH * texts.rdd.getNumPartitions())
    buckets = max(PAIR_BUCKETS, BUCKETS_EACH * parts)
    survey = stored(_survey(texts, buckets).where(F.col("word").isNull() | (F.col("count") >= least)), "words")
    known = _frequent_filter(survey.where("word IS NOT NULL"), filter_bits)
    # At most parts / HOT_SHARE buckets hold so much.
    load = survey.where("bucket IS NOT NULL")
    total = load.agg(F.sum("count")).first()[0] or 0
    hot = np.zeros(buckets, bool)
    for row in load.where(F.col("count") > HOT_SHARE * total / parts).select("bucket").collect():
        hot[row.bucket] = True
    level = _rows(texts, known, hot, buckets).repartition(parts, "deal")
    keep = ["deal", "lang", "k", "gram"]
    # From the edges down: what is counted whole and often stays, the rest flows into its head.
    for k in range(LONGEST, 2, -1):
        level = level.groupBy(*keep).agg(F.sum("count").alias("count"))
        whole = F.lit(True) if k == LONGEST else F.col("deal") >= 0
        is_level = F.col("k") == k
        shorter = F.struct(F.lit(k - 1).cast("tinyint").alias("k"), head("gram", k - 1).alias("gram"), F.lit(True).alias("on"))
        same = F.struct(F.col("k"), F.col("gram"), (~is_level | ~whole | (F.col("count") >= least)).alias("on"))
        both = F.when(is_level, F.array(same, shorter)).otherwise(F.array(same))
        level = (
            level.withColumn("x", F.explode(both)).where("x.on").select("deal", "lang", F.col("x.k").alias("k"), F.col("x.gram").alias("gram"), "count")
        )
    level = level.groupBy(*keep).agg(F.sum("count").alias("count")).where((F.col("deal") < 0) | (F.col("count") >= least))
    counts = level.groupBy("lang", "k", "gram").agg(F.sum("count").alias("count")).where(F.col("count") >= least)
    words = survey.where("word IS NOT NULL").select("lang", F.lit(1).cast("tinyint").alias("k"), F.col("word").alias("gram"), "count")
    n = survey.where("word IS NULL AND bucket IS NULL").select("lang", F.col("count").alias("n"))
    return stored(counts.unionByName(words), "phrases"), n


def unary_nodes(counts: DataFrame) -> DataFrame:
    """Inner nodes of unary paths: one edge in, one out, both as heavy as the node itself."""
    edges = counts.where(F.col("k") == LONGEST)
    side = lambda words, name: edges.groupBy("lang", head("gram", words).alias("gram")).agg(F.max("count").alias(name))
    out, into = side(LONGEST - 1, "out"), side(1 - LONGEST, "into")
    # An edge as heavy as its node leaves no weight for another one.
    nodes = counts.where(F.col("k") == LONGEST - 1).join(out, ["lang", "gram"]).join(into, ["lang", "gram"])
    return nodes.where("out = count AND into = count").select("lang", "gram")


def collocations(docs: DataFrame, least: int = 30, absorb: int = 80, top: int = 2000, filter_bits: int = FILTER_BITS) -> DataFrame:
    """The ``top`` phrases of 2 to 4 words of each language: lang, rank, phrase, a, l, r, n, score.

    The score of a phrase seen ``a`` times is that of its weakest cut into parts seen ``l`` and
    ``r`` times, ``floor(2000000 * a / (l + r))``. Phrases inside a longer one that is seen at
    least ``absorb`` percent as often are left out.
    """
    counts, n = phrase_counts(docs, least, filter_bits)
    cuts = F.explode(F.sequence(F.lit(1), F.col("k") - 1).cast("array<int>"))
    longer = counts.where("k > 1")
    scored = longer.join(unary_nodes(counts), ["lang", "gram"], "left_anti")
    split = scored.withColumn("cut", cuts).select(
        "lang", "gram", F.col("count").alias("a"), "cut", head("gram", F.col("cut")).alias("first"), head("gram", F.col("cut") - F.col("k")).alias("rest")
    )
    part = lambda name, value: counts.select("lang", F.col("gram").alias(name), F.col("count").alias(value))
    weakest = (
        split.join(part("first", "l"), ["lang", "first"])
        .join(part("rest", "r"), ["lang", "rest"])
        .withColumn("score", F.expr(f"cast(cast(a as decimal(28, 0)) * {SCALE} div (l + r) as bigint)"))
        .groupBy("lang", "gram", "a")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("w"))
    )
    # The words of a longer phrase from i on, for every shorter length.
    inner = F.expr(
        "explode(flatten(transform(sequence(2, k - 1), m -> transform(sequence(0, k - m), i ->"
        " substring_index(substring_index(gram, ' ', i + m), ' ', -m)))))"
    )
    inside = longer.where("k > 2").select("lang", inner.alias("gram"), "count").groupBy("lang", "gram").agg(F.max("count").alias("outer"))
    left = weakest.join(inside, ["lang", "gram"], "left").where(
        F.expr(f"outer IS NULL OR cast(outer as decimal(28, 0)) * 100 < cast(a as decimal(28, 0)) * {absorb}")
    )
    order = Window.partitionBy("lang").orderBy(F.desc("w.score"), F.desc("a"), "gram")
    ranked = left.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(n, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), F.col("gram").alias("phrase"), "a", "w.l", "w.r", "n", "w.score"
    )


SQL = r"""
WITH words AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents WHERE text IS NOT NULL),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM words GROUP BY lang),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM words),
sized AS (SELECT lang, w, i, unnest(range(1, least(4, len(w) - i + 1) + 1)) AS k FROM starts),
f AS (SELECT lang, k, w[i:i + k - 1] AS gram, count(*) AS a FROM sized GROUP BY ALL HAVING count(*) >= 30),
cuts AS (SELECT lang, k, gram, a, unnest(range(1, k)) AS cut FROM f WHERE k > 1),
scored AS (
  SELECT c.lang, c.k, c.gram, c.a, c.cut, l.a AS l, r.a AS r, (2000000::HUGEINT * c.a) // (l.a + r.a) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.gram = c.gram[:c.cut]
  JOIN f r ON r.lang = c.lang AND r.gram = c.gram[c.cut + 1:]),
weakest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, cut) = 1),
lengths AS (SELECT lang, gram, a, k, unnest(range(2, k)) AS m FROM f WHERE k > 2),
places AS (SELECT lang, gram, a, m, unnest(range(1, k - m + 2)) AS i FROM lengths),
inside AS (SELECT lang, gram[i:i + m - 1] AS gram, max(a) AS outer_a FROM places GROUP BY ALL),
ranked AS (
  SELECT w.*, array_to_string(w.gram, ' ') AS phrase FROM weakest w LEFT JOIN inside i ON i.lang = w.lang AND i.gram = w.gram
  WHERE outer_a IS NULL OR 100::HUGEINT * outer_a < 80::HUGEINT * w.a),
numbered AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM ranked)
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n, score::BIGINT AS score
FROM numbered JOIN n USING (lang) WHERE rank <= 2000
"""
