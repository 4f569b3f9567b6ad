"""Periodic runs, collocations and fingerprints against brute force, on odd rows and empty tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from dockline.llm import collocations, fingerprints, periods
from dockline.llm.queries import QUERIES, with_period
from dockline.session import configure
from tests.conftest import SF_DIR
from tests.llm.test_corpus import TEXTS, prose

LONG = " ".join(["one two three four five six seven"] * 3000) + " " + prose(77, 3000)
ROWS = [*TEXTS, (20, LONG), (21, "na " * 9), (22, "a b a b a b a b a a a a a a"), (-3, "x y z " * 5 + "x")]


@pytest.fixture(scope="module")
def docs(spark):
    configure(spark)
    rows = [(i, t, ("en", None, "de x")[k % 3], "clash", 1, "clash") for k, (i, t) in enumerate(ROWS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, runs string, count int, `a.b` string")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def all_runs(words: list, exponent: int = 4, least: int = 6) -> list[tuple[int, int, int]]:
    """Every run, by trying all periods at all places."""
    found: dict[tuple[int, int], int] = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i > start and i + q - start >= max(least, exponent * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def without(words: list, runs: list[tuple[int, int, int]]) -> str:
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_are_all_found():
    rng = np.random.default_rng(1)
    for _ in range(400):
        texts = []
        for _ in range(rng.integers(1, 5)):
            n, size = int(rng.integers(0, 70)), int(rng.integers(1, 4))
            words = [b"%d" % x for x in rng.integers(0, size, n)]
            if n > 3 and rng.random() < 0.7:
                first = int(rng.integers(0, n))
                q = 1 + (n - first) // int(rng.integers(3, 11))
                words = [words[i] if i < first else words[first + (i - first) % q] for i in range(n)]
            if n > 5 and rng.random() < 0.4:
                words = (words[:4] * int(rng.integers(1, 6)) + [b"x"]) * 5
            texts.append(words)
        for words, (runs, left) in zip(texts, periods.scan(texts, 4, 6)):
            assert runs == all_runs(words)
            assert left.decode() == without([w.decode() for w in words], runs)


def test_successor_is_the_least_value_from_a_bound_on():
    rng = np.random.default_rng(2)
    for n in (1, 2, 3, 64, 100):
        values = rng.permutation(n)
        tree = periods.WaveletTree(values)
        low = rng.integers(0, n, 200)
        high = np.minimum(low + rng.integers(0, n + 1, 200), n)
        bound = rng.integers(0, n + 3, 200)
        expected = [min([v for v in values[a:b] if v >= x], default=n) for a, b, x in zip(low, high, bound)]
        assert tree.successor(low, high, bound).tolist() == expected


def test_long_stretches_and_groups_of_documents():
    texts = [[b"a"] * 300_000, [], [b"a", b"b", b"a", b"a", b"c"] * 40_000, [b"z"]]
    assert [runs for runs, _ in periods.scan(texts, 4, 6)] == [[(0, 300_000, 1)], [], [(0, 200_000, 5)], []]


def expected_runs(doc_id: int | None, text: str | None) -> tuple:
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = all_runs(words) if len(words) < 5000 else None
    if runs is None:
        return (doc_id,)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    own = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *own, sha(lines), sha(without(words, runs)))


def test_periodic_runs_of_all_documents(spark, docs):
    out = periods.digests(periods.periodic_runs(docs, rewrite=with_period)).collect()
    key = repr
    assert sorted((tuple(r) if r.doc_id != 20 else (20,) for r in out), key=key) == sorted((expected_runs(i, t) for i, t in ROWS), key=key)
    long = next(r for r in out if r.doc_id == 20)
    assert (long.n_runs, long.start, long.length, long.period) == (1, 0, 21_000, 7)
    rows = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    some = {r.doc_id: r.text for r in rows if len(r.text or "") < 6000}
    found = {r.doc_id: tuple(r) for r in QUERIES["op11_periodic_runs"](spark, SF_DIR).collect()}
    assert len(found) == len(rows) and all(found[i] == expected_runs(i, t) for i, t in some.items())
    assert any(r[1] for r in found.values())


def expected_phrases(rows, least: int, absorb: int, top: int) -> list[tuple]:
    f: dict[str, Counter] = {}
    total: Counter = Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    f.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    out = []
    for lang, counts in f.items():
        ranked = []
        for gram, a in counts.items():
            if len(gram) == 1 or a < least:
                continue
            longer = (g for g, c in counts.items() if c >= least and len(g) > len(gram) and 100 * c >= absorb * a)
            if any(g[i : i + len(gram)] == gram for g in longer for i in range(len(g) - len(gram) + 1)):
                continue
            cuts = [(2_000_000 * a // (counts[gram[:k]] + counts[gram[k:]]), k) for k in range(1, len(gram))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(gram).encode(), counts[gram[:k]], counts[gram[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def test_collocations_of_odd_rows(spark, docs, monkeypatch):
    rng = np.random.default_rng(4)
    more = [(("en", None)[i % 2], "  ".join(f"W{x}{',' if x == 2 else ''}" for x in rng.integers(0, 6, 40))) for i in range(30)]
    more += [("en", "hot pair here.\thot Pair there! Hot pair") for _ in range(60)]
    extra = spark.createDataFrame(more, "lang string, text string")
    rows = docs.where("doc_id is null or doc_id <> 20").select("lang", "text").unionByName(extra)
    brute = lambda least, absorb, top: expected_phrases([tuple(r) for r in rows.collect()], least, absorb, top)
    found = lambda *options: sorted(map(tuple, collocations.collocations(rows, *options).collect()))
    assert found(3, 80, 2000) == brute(3, 80, 2000)
    assert found(30, 100, 4) == brute(30, 100, 4)
    # Every bucket is dealt by whole edges; a filter that takes every word for frequent.
    monkeypatch.setattr(collocations, "HOT_SHARE", 0)
    assert found(3, 80, 2000, 8) == brute(3, 80, 2000)


def test_pieces_and_ends_give_the_flow(spark):
    docs = spark.createDataFrame([("en", "a b c d e. a b c"), ("en", "b c\nA B"), ("en", None), ("en", "")], "lang string, text string")
    counts, n = collocations.phrase_counts(docs, 1)
    found = {r.gram: r["count"] for r in counts.collect()}
    assert found["a b"] == 3 and found["b c"] == 3 and found["a b c"] == 2 and found["b c d"] == 1 and found["c"] == 3
    assert n.first().n == 12 and len(found) == 5 + 4 + 3 + 2
    assert [r.gram for r in collocations.unary_nodes(counts).collect()] == ["b c d"]


def test_primes_and_spans():
    for prime in fingerprints.PRIMES:
        assert all(prime % d for d in range(2, int(prime**0.5) + 1))
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 3, 400).astype(np.uint32)
    for prime in (0, 1):
        table = fingerprints.Prefixes(codes, prime)
        spans = [(int(a), int(a) + int(n)) for a, n in zip(rng.integers(0, 390, 300), rng.integers(0, 10, 300))]
        by_hash = {}
        for a, b in spans:
            by_hash.setdefault((b - a, int(table.span(a, b))), set()).add(codes[a:b].tobytes())
        assert all(len(x) == 1 for x in by_hash.values())
        assert len(by_hash) == len({codes[a:b].tobytes() for a, b in spans})


def test_likeness():
    mark = lambda *texts: [m.text() for m in fingerprints.marks_of(list(texts))]
    text = prose(5, 300)
    words = text.split()
    one, same, empty, none, other = mark(text, text, "", "", prose(6, 300))
    assert one == same and fingerprints.likeness(one, same) == 1.0 == fingerprints.likeness(empty, none)
    assert fingerprints.likeness(one, empty) == 0.0 and fingerprints.likeness(one, other) < 0.1
    changed, moved = mark(" ".join([*words[:150], "new", *words[151:]]), " ".join([*words[200:], *words[:200]]))
    assert 0.9 < fingerprints.likeness(one, changed) < 1 and fingerprints.likeness(one, moved) > 0.6
    assert fingerprints.likeness(one, changed) == fingerprints.likeness(changed, one)
    # Every length of a common start is found to within a sampled step.
    for n in range(0, len(text), 97):
        a, b = mark(text, text[:n] + prose(9, 300)[: len(text) - n])
        assert abs(fingerprints.likeness(a, b) - n / len(text)) < 0.08
    flat = mark(*("z" * n for n in range(1, 60)))
    assert len(set(flat)) == 59 and fingerprints.likeness(flat[40], flat[41]) > 0.9
    for a in mark(text, "short", "a", LONG):
        assert fingerprints.parse(a).text() == a


def test_fingerprints_in_order_of_ids(spark, docs):
    rows = [(None, f"none {i}") for i in range(30)] + [(5, "same")] * 40 + [(5, f"text {i}") for i in range(200)] + [(-7, ""), (9, None)]
    hot = spark.createDataFrame(rows, "doc_id bigint, text string")
    for df in (docs, hot):
        plain = [(r.doc_id, r.text or "", r.tie) for r in df.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie")).collect()]
        plain.sort(key=lambda r: (r[0] is None, -(r[0] or 0), -r[2]))
        expected = []
        for i, (doc_id, text, _) in enumerate(plain):
            after = plain[(i + 1) % len(plain)][1]
            half = len(text) // 2
            changed = text[: len(text) - half] + after[:half]
            own, new, following = fingerprints.marks_of([text, changed, after])
            expected.append((doc_id, len(text), sha(changed), own.text(), new.text(), fingerprints.alike(own, new), fingerprints.alike(own, following)))
        assert sorted(map(repr, map(tuple, fingerprints.fingerprints(df).collect()))) == sorted(map(repr, expected))


def test_fingerprint_columns(spark, docs):
    pairs = docs.select(fingerprints.fingerprint(F.col("text")).alias("f"))
    out = pairs.select(fingerprints.near(F.col("f"), F.col("f")).alias("n"), fingerprints.near(F.col("f"), F.lit(None).cast("string")).alias("none"))
    assert {tuple(r) for r in out.collect()} == {(1.0, None)}


def test_empty_tables(docs):
    nothing = docs.where("1 = 0")
    assert periods.digests(periods.periodic_runs(nothing)).count() == 0
    assert collocations.collocations(nothing).count() == 0
    assert fingerprints.fingerprints(nothing).count() == 0
    one = docs.where("doc_id = 6")
    assert [r.near_next for r in fingerprints.fingerprints(one).collect()] == [1.0]
