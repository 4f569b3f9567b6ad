"""The corpus operators on small fixtures: brute force, odd rows, empty tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dockline.llm import bpe, licences, linededup, neardup, packing, pii, quality, sharding, topk, toxicity
from dockline.llm.queries import ORACLE, QUERIES
from dockline.session import configure
from tests.conftest import SF_DIR
from tests.oracle import compare, connect

MULTI = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PLAIN = public_tokenizers.path("byte_bpe_50k.json")

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(seed: int, n: int) -> str:
    rng = np.random.default_rng(seed)
    return " ".join(f"{WORDS[i]}{j}" for i, j in zip(rng.integers(0, len(WORDS), n), rng.integers(0, 50, n)))


BLOCK = "\n".join(prose(900 + i, 12) for i in range(4))
TEXTS = [
    (0, prose(1, 80)),
    (1, prose(1, 80)),
    (2, prose(1, 80) + " more"),
    (3, None),
    (4, ""),
    (5, " \n\t "),
    (6, "Two words"),
    (7, "two WORDS"),
    (8, f"{prose(2, 9)}\n{BLOCK}\n{prose(3, 9)}"),
    (9, f"{prose(4, 9)}\n{BLOCK}\n{prose(5, 9)}"),
    (10, "mail a.b@c.example.com, ip 1.2.3.4 and 1.2.3.999, card 4111 1111 1111 1111, call +1 (234) 555-0100 now"),
    (11, "x@y.z_q@r.s 0001.2.3.4.5.6.7.8 +12345678901234567 \U0001f600 tel (555) 123-4567"),
    (12, "it's DON'T I'll  we've  \x1c\x85 ٣Ⅷ \U0001f600\n\n  <|endoftext|> end"),
    (13, "z" * 5000 + " " + "9 " * 3000),
    (None, "a row without an id"),
    (14, prose(6, 400)),
    (14, prose(6, 400)),
]


@pytest.fixture(scope="module")
def docs(spark):
    configure(spark)
    rows = [(i, t, "en", f"src{k % 3}" if k % 5 else None, "clash", 1) for k, (i, t) in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, kept string, n int")


@pytest.fixture(scope="module")
def nothing(docs):
    return docs.where("1 = 0")


def rows_of(df):
    return [r.asDict() for r in df.collect()]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    assert compare(QUERIES[name](spark, SF_DIR), connect(SF_DIR), ORACLE[name]) is None


def test_empty_tables(spark, nothing):
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    vectors = spark.createDataFrame([], "vec_id bigint, embedding array<float>")
    for df in (
        topk.top_k(vectors),
        linededup.dedup_lines(nothing),
        toxicity.score_documents(nothing, labels),
        sharding.shard_documents(nothing),
        neardup.near_duplicates(nothing),
        bpe.round_trip(nothing, MULTI, public_tokenizers.PATTERN),
        quality.judge(nothing),
        packing.pack(nothing, PLAIN),
        pii.find(nothing),
        licences.scan(nothing),
    ):
        assert df.count() == 0


def test_top_k_with_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (100, [1e12, 1.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, [nan, 1.0]), (3, [inf, 1.0])]
    rows += [(4, [None, 1.0]), (5, None), (None, [1.0, 1.0]), (6, [1.0]), (7, [0.5, 0.5]), (200, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").withColumn("rank", F.lit("clash"))
    found = [tuple(r) for r in topk.top_k(df).orderBy("query_id", "rank").collect()]
    assert [r[:3] for r in found if r[0] == 0] == [(0, 1, 100), (0, 2, 1), (0, 3, 7)]
    assert [r[2] for r in found if r[0] == 100] == [1, 7, 0]
    assert not [r for r in found if r[0] == 200]


def test_pivots_give_the_exact_best():
    rng = np.random.default_rng(5)
    q, c = rng.integers(-600, 600, (7, 16)), rng.integers(-600, 600, (900, 16))
    pivots = topk.far_apart(c.astype(float), 12)
    table = lambda x: np.sqrt(((x[:, None, :] - pivots[None]) ** 2).sum(-1))
    i, j, score, _ = topk.best_of_block((np.arange(7), q, table(q)), (np.arange(900), c, table(c)), 10)
    for k in range(7):
        own = c @ q[k]
        own[k] = -(1 << 60)
        assert sorted(score[i == k], reverse=True) == sorted(own, reverse=True)[:10]


def test_line_dedup(docs):
    out = {r["doc_id"]: r for r in rows_of(linededup.dedup_lines(docs).where("doc_id <> 14"))}
    assert out[8]["text"] == dict(TEXTS)[8] and out[9]["lines_removed"] == 4
    assert out[9]["text"] == f"{prose(4, 9)}\n{prose(5, 9)}"
    assert out[1]["emptied"] and not out[0]["emptied"] and out[3]["text"] is None
    assert out[0]["kept"] == "clash" and not out[5]["emptied"]
    assert linededup.drop_repeated_lines(docs).columns == docs.columns


def test_alignment_rises_and_matches():
    rng = np.random.default_rng(0)
    for _ in range(200):
        a, b = (rng.integers(0, 8, rng.integers(0, 15)).tolist() for _ in range(2))
        pairs = linededup.align(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    assert linededup.align([1, 2, 3, 9], [7, 1, 2, 3]) == [(0, 1), (1, 2), (2, 3)]


def test_blocks_that_come_twice_or_without_single_lines():
    sizes = [60, 60]
    assert linededup.common_blocks([1, 2, 7], [1, 2, 8, 1, 2], [60, 60, 60, 60, 60]) == [(0, 2), (3, 5)]
    assert linededup.common_blocks([5, 1, 2, 6, 1, 2, 7], [8, 1, 2, 9, 1, 2, 4], [60] * 7) == [(1, 3), (4, 6)]
    assert linededup.common_blocks([1, 9, 2], [1, 2], sizes) == []


def test_a_passage_out_of_order_behind_short_lines(spark):
    """[h1,a,h2,b,h3,P] and [P,x,h1,y,h2,z,h3]: the alignment prefers the three short lines."""
    left, right = [1, 11, 2, 12, 3, 9, 8], [9, 8, 21, 1, 22, 2, 23, 3]
    assert linededup.common_blocks(left, right, [90, 70, 40, 30, 40, 30, 40, 30]) == [(0, 2)]
    heads, passage = [f"heading number {i}" for i in range(3)], prose(950, 60)
    one = "\n".join([heads[0], prose(951, 8), heads[1], prose(952, 8), heads[2], passage])
    rest = [prose(953, 8), heads[0], prose(954, 8), heads[1], prose(955, 8), heads[2]]
    docs = spark.createDataFrame([(1, one), (2, "\n".join([passage, *rest]))], "doc_id int, text string")
    out = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs).collect()}
    assert out == {1: one, 2: "\n".join(rest)}


def test_no_shared_run_is_left():
    rng = np.random.default_rng(8)
    for _ in range(400):
        a, b = (rng.integers(0, 7, rng.integers(1, 25)).tolist() for _ in range(2))
        chars = rng.integers(0, 70, 7)
        sizes = [int(chars[x]) for x in b]
        gone = [False] * len(b)
        for first, last in linededup.common_blocks(a, b, sizes):
            assert sum(sizes[first:last]) >= 100 and any(a[k : k + last - first] == b[first:last] for k in range(len(a)))
            gone[first:last] = [True] * (last - first)
        for first in range(len(b)):
            for last in range(first + 1, len(b) + 1):
                if not any(gone[first:last]) and sum(sizes[first:last]) >= 100:
                    assert not any(a[k : k + last - first] == b[first:last] for k in range(len(a)))


def test_runs_are_hashed_alike_wherever_they_stand():
    rng = np.random.default_rng(2)
    for _ in range(100):
        hashes, sizes = rng.integers(-(1 << 62), 1 << 62, 6), rng.integers(0, 60, 6)
        head, tail = rng.integers(0, 9, 3), rng.integers(0, 9, 4)
        longer = linededup.run_hashes(np.concatenate([head, hashes, tail]), np.concatenate([head, sizes, tail]))
        assert set(linededup.run_hashes(hashes, sizes)) <= set(longer)
        assert len(linededup.run_hashes(hashes, sizes)) == sum(sizes[i:].sum() >= 100 and sizes[i] > 0 for i in range(6))


def test_lines_are_cut_and_hashed_alike():
    rng = np.random.default_rng(12)
    letters = list("ab .!\n\r\t\")'\u2026\u0964\u3002\uff1f\U0001f600")
    texts = ["".join(rng.choice(letters, int(rng.integers(1, 40)))) for _ in range(600)]
    hashes, sizes, edges = linededup.lines_of(texts)
    by_line = {}
    for text, a, b in zip(texts, edges, edges[1:]):
        lines = [x.strip(" \t\n\v\f\r") for x in linededup._LINE_END.split(text)]
        assert sizes[a:b].tolist() == [len(x) for x in lines], text
        for line, code in zip(lines, hashes[a:b].tolist()):
            assert by_line.setdefault(line, code) == code
    assert len(set(by_line.values())) == len(by_line)


def test_passages_whatever_surrounds_them(spark):
    """Other line breaks, tabs, stops of other scripts, closing quotation marks."""
    passage = [prose(960 + i, 15) for i in range(4)]
    own = lambda i: prose(970 + i, 12)
    one = f"{own(0)}\n" + "\n".join(passage) + f"\n{own(1)}"
    texts = {
        1: one,
        2: f"{own(2)}\r\n" + "\r\n".join(passage) + f"\r\n{own(3)}",
        3: f"{own(4)}\n" + "\n".join(f"\t{x}  " for x in passage) + f"\n{own(5)}",
        10: f'{own(6)}. ' + " ".join(f'{x}."' for x in passage) + f' {own(7)}',
        11: f'{own(8)}. ' + " ".join(f'{x}."' for x in passage) + f' {own(9)}',
        20: f"{own(10)}\u0964 " + " ".join(f"{x} x\u0964" for x in passage) + f" {own(11)}",
        21: f"{own(12)}\u0964 " + " ".join(f"{x} x\u0964" for x in passage) + f" {own(13)}",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    out = {r["doc_id"]: (r["text"], r["lines_removed"]) for r in linededup.dedup_lines(docs).collect()}
    assert all(out[i][0] == texts[i] for i in (1, 10, 20))
    assert out[2][0] == f"{own(2)}\r\n{own(3)}" and out[3][0] == f"{own(4)}\n{own(5)}"
    assert out[11] == (f"{own(8)}. {own(9)}", 4) and out[21] == (f"{own(12)}\u0964 {own(13)}", 4)


def test_line_dedup_inside_lines(spark):
    """Passages within lines; blocks whose lines have other first holders one by one; kept line breaks."""
    passage = ". ".join(prose(700 + i, 14) for i in range(5)) + "."
    one, two = prose(800, 6), prose(801, 12)
    texts = {
        1: f"{prose(1, 9)}. {passage} {prose(2, 5)}",
        2: f"{prose(3, 9)}. {passage} {prose(4, 5)}\n{prose(5, 5)}",
        3: f"{prose(6, 9)}. {passage}\n{prose(7, 5)}\n{passage}",
        4: f"{one}\n{prose(8, 30)}",
        5: f"{prose(9, 30)}\n{two}",
        6: f"{one}\n{two}\n{prose(10, 7)}",
        7: f"{prose(11, 7)}\n{one}\n{two}",
        8: f"{prose(12, 30)}. {one}",
    }
    docs = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    out = {r["doc_id"]: r["text"] for r in linededup.dedup_lines(docs).collect()}
    assert {i: out[i] for i in (1, 4, 5, 6, 8)} == {i: texts[i] for i in (1, 4, 5, 6, 8)}
    assert out[2] == f"{prose(3, 9)}. {prose(4, 5)}\n{prose(5, 5)}"
    assert out[3] == f"{prose(6, 9)}. \n{prose(7, 5)}\n"
    assert out[7] == f"{prose(11, 7)}\n"


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_is_edit_distance():
    terms = ["idiot", "worthless", "scum", "disgusting"]
    machine, rng = toxicity.Automaton(terms), np.random.default_rng(1)
    words = ["", *terms]
    for term in terms * 150:
        letters = list(term)
        for _ in range(rng.integers(0, 4)):
            at, what = rng.integers(0, len(letters) + 1), rng.integers(0, 3)
            letters[at : at + (what != 0)] = [] if what == 1 else [str(rng.choice(list("idoxtsu")))]
        words.append("".join(letters))
    for word in words:
        near = [distance(word, t) for t in terms if distance(word, t) <= toxicity.edits_allowed(len(t))]
        assert machine.match(word) == (0 if not near else 1 if min(near) == 0 else 2), word


def test_quotation_is_told_from_abuse():
    memory = toxicity.Memory(["idiot"])
    assert toxicity.hits("you idiot", memory)[:3] == (1, 0, 0)
    assert toxicity.hits("you idoit there idjot", memory)[:3] == (0, 1, 0)
    assert toxicity.hits('they wrote "an idiot" there', memory)[:3] == (0, 0, 1)
    assert toxicity.hits("", memory) == (0, 0, 0, 0)


def test_quotations_are_measured_in_words():
    memory = toxicity.Memory(["idiot"])
    long = " ".join(["incomprehensibility"] * 14)
    assert toxicity.hits(f'he said "{long} idiot, {long}" again', memory)[:3] == (0, 0, 1)
    # A quotation that is over by now, however long it was.
    words = " ".join(["word"] * 60)
    assert toxicity.hits(f'"{words}" you idiot, he said "no"', memory)[:3] == (1, 0, 0)
    assert toxicity.hits(f'{words} "a" "b" you idiot', memory)[:3] == (1, 0, 0)
    # Opened or closed too far away, or on another line.
    assert toxicity.hits(f'"{words} idiot"', memory)[:3] == (1, 0, 0) == toxicity.hits(f'"idiot {words}"', memory)[:3]
    assert toxicity.hits('"you\nidiot"', memory)[:3] == (1, 0, 0) == toxicity.hits('"\n" idiot', memory)[:3]


def test_toxicity_patterns_agree():
    """Each set of patterns finds the same words in the texts that it is for."""
    texts = ["id1ot x_y 12² a@b$c*d", "क्षमा é1é ß_İ ʼn", "\U00010400\U00010401 1 \U0001f600a0b", ""]
    for text in texts:
        for patterns in (toxicity.ASCII, toxicity.BASIC):
            if text.isascii() or (patterns is toxicity.BASIC and not toxicity.BEYOND_BASIC.search(text)):
                for name in ("letters", "inside", "mixed"):
                    mine, full = getattr(patterns, name), getattr(toxicity.ANY, name)
                    assert [m.span() for m in mine.finditer(text.lower())] == [m.span() for m in full.finditer(text.lower())]


def test_signs_in_words_and_combining_marks():
    memory = toxicity.Memory(["idiot", "moron", "worthless", "मूर्ख", "cafe\u0301"])
    for text in ("you id1ot", "a m0ron.", "w0rthl3ss", "wor*hless", "mor@n"):
        assert toxicity.hits(text, memory) == (0, 1, 0, 1), text
    assert toxicity.hits("तुम मूर्ख हो", memory) == (1, 0, 0, 1) == toxicity.hits("le cafe\u0301 la", memory)
    # Joined words stay hits of their own; other signs change nothing.
    assert toxicity.hits("idiot2you moron*idiot", memory) == (3, 0, 0, 3)
    assert toxicity.hits("so 'an \"id1ot\"' there", memory) == (0, 0, 1, 0)
    assert toxicity.hits("a1b2c3 x@y.org 5 * 3 z9", memory) == (0, 0, 0, 0)
    assert toxicity.LETTERS.findall("क्षमा x_y 12²") == ["क्षमा", "x", "y"]


def test_toxicity_held_out(spark, docs):
    scores = QUERIES["op3_toxicity"](spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    seen = scores.where("held_out").join(labels, "doc_id").groupBy("predicted", "toxic").count()
    counts = {(r["predicted"], r["toxic"]): r["count"] for r in seen.collect()}
    hit = counts[(1, 1)]
    assert hit / (hit + counts.get((1, 0), 0)) > 0.85 and hit / (hit + counts.get((0, 1), 0)) > 0.85
    none = toxicity.score_documents(docs, labels.where("1 = 0"))
    assert none.count() == len(TEXTS) and none.where("predicted = 1").isEmpty()


def jump(key: int, buckets: int) -> int:
    b, j = -1, 0
    while j < buckets:
        b, key = j, (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * (float(1 << 31) / float((key >> 33) + 1)))
    return b


def test_shards(docs):
    keys = np.random.default_rng(2).integers(0, 1 << 63, 500).astype(np.uint64)
    for n in (1, 2, 40, 41):
        assert sharding.jump(keys, n).tolist() == [jump(int(k), n) for k in keys]
    out = rows_of(sharding.shard_documents(docs, 3))
    assert len(out) == len(TEXTS) and all(r["grown_shard"] in (r["shard"], 3) for r in out)
    for shard in range(3):
        slots = sorted(r["slot"] for r in out if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    text = dict(TEXTS)
    for r in out:
        if r["doc_id"] is not None:
            data = (text[r["doc_id"]] or "").encode()
            assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))


def test_near_duplicates(docs):
    out = {r["doc_id"]: r for r in rows_of(neardup.near_duplicates(docs))}
    assert [out[i]["component_id"] for i in (0, 1, 2, 3, 4, 6, 7)] == [0, 0, 0, 3, 4, 6, 6]
    assert out[3]["n_shingles"] == out[5]["n_shingles"] == 0 and out[6]["n_shingles"] == 1
    assert out[None]["component_id"] is None and out[None]["kept"] and out[14]["component_id"] == 14


def test_one_row_of_each_kept_id_is_left(spark, docs):
    out = rows_of(neardup.drop_near_duplicates(docs))
    assert sorted(r["doc_id"] for r in out if r["doc_id"] is not None) == [0, 3, 4, 5, 6, 8, 9, 10, 11, 12, 13, 14]
    assert [r["text"] for r in out if r["doc_id"] is None] == ["a row without an id"]
    # One id holds a third of the rows, with texts of their own.
    rows = [(1 if i % 3 else 1000 + i, prose(i, 30), "en") for i in range(60)] + [(None, "x", "en")] * 2
    few = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    out = neardup.drop_near_duplicates(few)
    assert out.columns == few.columns
    found = [r["doc_id"] for r in out.collect()]
    assert len(found) == 23 and found.count(1) == 1 and found.count(None) == 2


def test_near_duplicates_in_a_group_without_a_centre(spark):
    """Copies with growing edits: linked in chains, and many that just miss the threshold."""
    base, rng = prose(50, 120).split(), np.random.default_rng(3)
    rows = []
    for i in range(300):
        words = list(base)
        for at in rng.choice(len(words), int(rng.integers(0, 9)), replace=False):
            words[at] = f"new{i}x{at}"
        rows.append((i, " ".join(words)))
    found = {r["doc_id"]: r["component_id"] for r in rows_of(neardup.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")))}
    sets = [{tuple(t.split()[k : k + 5]) for k in range(116)} for _, t in rows]
    label = list(range(300))
    changed = True
    while changed:
        changed = False
        for a in range(300):
            for b in range(a):
                if label[a] != label[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    assert [found[i] for i in range(300)] == label


@pytest.mark.parametrize("few", [0, 40, 500_000])
def test_components(spark, monkeypatch, few):
    """Chains, stars and random links, with copies of links and links of a node to itself."""
    from dockline.llm import components as module

    monkeypatch.setattr(module, "FEW_LINKS", few)
    rng = np.random.default_rng(6)
    pairs = [(i, i + 1) for i in range(100, 160)] + [(int(x), 200) for x in range(201, 260)] + [(7, 7), (300, 301), (301, 300), (300, 301)]
    pairs += [(int(x), int(y)) for x, y in rng.integers(400, 520, (90, 2))] + [(999 - i, 998 - i) for i in range(0, 300, 1) if i % 50]
    label = {x: x for pair in pairs for x in pair if pair[0] != pair[1]}
    for _ in label:
        for a, b in pairs:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    found = module.components(spark.createDataFrame(pairs, "a bigint, b bigint"))
    assert {r.node: r.component for r in found.collect()} == label
    assert module.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_bpe_round_trip(docs):
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(MULTI), special_tokens={})
    sha = lambda data: hashlib.sha256(data).hexdigest()
    expected = sorted(
        (i if i is not None else -1, len(ids := coder.encode_ordinary(t or "")), sha(",".join(map(str, ids)).encode()), sha((t or "").encode()))
        for i, t in TEXTS
    )
    out = bpe.round_trip(docs, MULTI, public_tokenizers.PATTERN).fillna(-1, ["doc_id"])
    assert sorted(tuple(r) for r in out.collect()) == expected
    back = bpe.decode(bpe.encode(docs, MULTI, public_tokenizers.PATTERN), MULTI).fillna(-1, ["doc_id"])
    assert sorted((r[0], bytes(r[1])) for r in back.collect()) == sorted((i if i is not None else -1, (t or "").encode()) for i, t in TEXTS)


def test_every_white_space_is_split_alike():
    import regex

    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.ranks(MULTI), special_tokens={})
    find = regex.compile(public_tokenizers.PATTERN).findall
    single = tiktoken.Encoding("one", pat_str=r"(?s).+", mergeable_ranks=bpe.ranks(MULTI), special_tokens={})
    for start in range(0, 0x3100, 16):
        text = "".join(f"a{chr(c)} {chr(c)}{chr(c)}b" for c in range(start, start + 16))
        assert coder.encode_ordinary(text) == [i for w in find(text) for i in single.encode_ordinary(w)], hex(start)


def test_packing(docs):
    tokenizer = Tokenizer.from_file(PLAIN)
    pieces = rows_of(packing.pack(docs.where("doc_id < 14"), PLAIN, with_ids=True))
    for i, text in TEXTS:
        if i is None or i == 14:
            continue
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted((p for p in pieces if p["doc_id"] == i), key=lambda p: p["start"])
        assert [x for p in own for x in p["ids"]] == ids
        assert [p["start"] for p in own] == np.cumsum([0, *(p["length"] for p in own)])[:-1].tolist()
        for p in own:
            assert p["doc_tokens"] == len(ids) and p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
    for sequence in {p["sequence_id"] for p in pieces}:
        own = sorted((p for p in pieces if p["sequence_id"] == sequence), key=lambda p: p["offset"])
        assert [p["offset"] for p in own] == np.cumsum([0, *(p["length"] for p in own)])[:-1].tolist()
        assert sum(p["length"] for p in own) <= 1024


def test_cuts_are_the_cheapest():
    rng = np.random.default_rng(4)
    for _ in range(50):
        places = sorted({0, 60, *rng.integers(1, 60, 25).tolist(), *range(0, 60, 8)})
        costs = [0, *rng.integers(0, 20, len(places) - 2).tolist(), 0]
        best = [0] + [10**9] * (len(places) - 1)
        for k in range(1, len(places)):
            for j in range(k):
                if places[k] - places[j] <= 16:
                    best[k] = min(best[k], best[j] + 16 - (places[k] - places[j]) + costs[k])
        cuts = packing.best_cuts(places, costs, 16)
        cost = dict(zip(places, costs))
        assert sum(16 - (b - a) + cost[b] for a, b in zip(cuts, cuts[1:])) == best[-1]


def luhn(number: str) -> bool:
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(x - 9 if x > 9 else x for x in twice) % 10 == 0


def base_spans(text: str) -> str:
    rules = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m, d: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m, d: all(int(x) <= 255 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m, d: 14 <= len(d) <= 19 and luhn(d)),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m, d: 10 <= len(d) <= 15),
    }
    found = []
    for rank, (kind, (pattern, good)) in enumerate(rules.items()):
        for m in re.finditer(pattern, text):
            if good(m.group(), re.sub("[^0-9]", "", m.group())):
                found.append((m.start(), rank, f"{kind}:{m.start()}:{m.end()}"))
    return ",".join(s for _, _, s in sorted(found))


def test_personal_data(docs):
    out = {r["doc_id"]: r for r in rows_of(pii.find(docs.where("doc_id < 14")))}
    for i, text in TEXTS:
        if i in out:
            assert out[i]["base_sha256"] == hashlib.sha256(base_spans(text or "").encode()).hexdigest(), i
    assert (out[10]["n_email"], out[10]["n_ip"], out[10]["n_card"], out[10]["n_phone"]) == (1, 1, 1, 1)
    redacted = {r["doc_id"]: r for r in rows_of(pii.redact(docs.where("doc_id < 14")))}
    assert redacted[10]["text"].startswith("mail <EMAIL>, ip <IP> and 1.2.3.999, card <CARD>, call <PHONE> now")
    assert redacted[3]["text"] is None and redacted[0]["text"] == dict(TEXTS)[0]


def test_planted_spans_of_each_added_kind(spark):
    planted = {
        "ssn": ["536-22-8726", "219-09-9999", "457-55-5462"],
        "national": ["(212) 555-0147", "415-555-2671", "646.253.0198"],
        "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "FR1420041010050500013M02606"],
        "spelled": ["ann.lee (at) example (dot) com", "bob [at] mail.org", "joe(at)site(dot)de"],
    }
    mixed = {(kind, x): f"some words {x} and more" for kind, spans in planted.items() for x in spans}
    for kinds in (*([k] for k in planted), list(planted)):
        texts = [(k, x, t) for (k, x), t in mixed.items() if k in kinds]
        df = spark.createDataFrame([(i, t) for i, (_, _, t) in enumerate(texts)], "doc_id bigint, text string")
        out = {r["doc_id"]: r["spans"] for r in rows_of(pii.find(df))}
        for i, (k, x, t) in enumerate(texts):
            assert out[i] == f"{k}:{t.index(x)}:{t.index(x) + len(x)}", (kinds, x)
    # Numbers that no check holds true of, in the form of an ssn, are not taken for one.
    wrong = [(i, f"part 000-{10 + i}-0000 of 9{i:02}-00-{1000 + i}") for i in range(40)]
    df = spark.createDataFrame(wrong, "doc_id bigint, text string")
    assert {r["spans"] for r in rows_of(pii.find(df))} == {""}


def test_added_spans_give_way_to_kept_ones_only(spark):
    """Against a walk over the spans with the end of the last one kept."""
    from dockline.llm.boosting import Boosted

    cases = [[(0, 30), (5, 10), (12, 20)], [(0, 12), (10, 22), (20, 30)], [(0, 5), (5, 9)], [(3, 4)], []]
    rng = np.random.default_rng(3)
    cases += [sorted((int(a), int(a + n)) for a, n in zip(rng.integers(0, 40, 6), rng.integers(1, 15, 6))) for _ in range(40)]
    rank = len(pii.BASE)
    rows = [(i, [(a, rank, b, True, True, (0,) * len(pii.FEATURES)) for a, b in spans]) for i, spans in enumerate(cases)]
    df = spark.createDataFrame(rows, f"id int, spans {pii._NO_SPANS}")
    chosen = pii.selected(F.col("spans"), Boosted(1.0, []), [0.0] * len(pii.KINDS))
    for i, found in ((r.id, [(s.start, s.end) for s in r.c]) for r in df.select("id", chosen.alias("c")).collect()):
        expected, at = [], 0
        for a, b in cases[i]:
            if a >= at:
                expected.append((a, b))
                at = b
        assert found == expected, cases[i]


def test_licences(spark):
    mit = (
        "MIT License\n\nPermission is hereby granted, free of charge, to any person obtaining a copy of this\nsoftware "
        "and associated documentation files (the \"Software\"), to deal in the Software without restriction, including "
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions:\n\nThe above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, "
        "EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT."
    )
    rows = [
        (0, mit),
        (1, "\n\n".join(reversed(mit.split("\n\n")))),
        (2, "text without a stop\nLicensed under CC BY-NC 4.0.\nmore"),
        (3, None),
        (4, "a licence is mentioned, no more"),
    ]
    out = {r["doc_id"]: r["licences"] for r in rows_of(licences.scan(spark.createDataFrame(rows, "doc_id bigint, text string")))}
    assert out == {0: ["MIT"], 1: [], 2: ["CC-BY-NC-4.0"], 3: [], 4: []}
    assert all(re.search(licences.CUES, s) for s in licences.SENTENCES.values())


GENUINE = {
    "Apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0 header": "Licensed under the Apache License, Version 2.0 (the \"License\");\nyou may not use this file except in "
    "compliance with the License.\nYou may obtain a copy of the License at\n\n    http://www.apache.org/licenses/LICENSE-2.0\n\n"
    "Unless required by applicable law or agreed to in writing, software\ndistributed under the License is distributed on an "
    "\"AS IS\" BASIS,\nWITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.\nSee the License for the rest.",
    "MIT notice": "Released under the MIT License.",
    "MIT reference": "Licensed under the MIT license",
    "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated "
    "documentation files (the \"Software\"), to deal\nin the Software without restriction, including without limitation the rights\n"
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell\ncopies of the Software, and to permit persons to "
    "whom the Software is\nfurnished to do so, subject to the following conditions:\n\nThe above copyright notice and this permission "
    "notice shall be included in all\ncopies or substantial portions of the Software.\n\nTHE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
    "WARRANTY OF ANY KIND, EXPRESS OR\nIMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,\nFITNESS FOR A "
    "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE\nAUTHORS BE LIABLE",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that "
    "the following conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this\n   list of "
    "conditions and the following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice,\n   this "
    "list of conditions and the following disclaimer in the documentation\n   and/or other materials provided with the distribution.",
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, "
    "provided that the above\ncopyright notice and this permission notice appear in all copies.",
    "GPL-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0 reference": "Licensed under the GNU General Public License\nversion 3",
    "GPL-2.0 notice": "This work is licensed under the GNU General Public License version 2.",
    "GPL-2.0 reference": "Licensed under the GNU General Public License, version 2",
    "GPL-3.0-or-later": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General "
    "Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later "
    "version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied "
    "warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.",
    "GPL-2.0-or-later": "This program is free software; you can redistribute it and/or modify\nit under the terms of the GNU General "
    "Public License as published by\nthe Free Software Foundation; either version 2 of the License, or\n(at your option) any later "
    "version.\n\nThis program is distributed in the hope that it will be useful,\nbut WITHOUT ANY WARRANTY; without even the implied "
    "warranty of\nMERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the\nGNU General Public License for more details.",
    "LGPL-3.0 notice": "Licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public\nLicense, v. 2.0. If a copy of the MPL was not "
    "distributed with this\nfile, You can obtain one at https://mozilla.org/MPL/2.0/.",
    **{f"CC-{x}-4.0": f"Licensed under CC {x} 4.0." for x in ("BY", "BY-NC", "BY-SA", "BY-ND", "BY-NC-SA", "BY-NC-ND")},
    "CC0-1.0": "Released under CC0 1.0.",
    "Unlicense": "This is free and unencumbered software released into the public\ndomain.",
    "All rights reserved": "All rights\nreserved.",
    "EPL-2.0 notice": "This program and the accompanying materials are made\navailable under the terms of the Eclipse Public License "
    "2.0\nwhich is available at https://www.eclipse.org/legal/epl-2.0/.",
    "Apache-2.0 text": "Apache License\n    Version 2.0, January 2004\n http://www.apache.org/licenses/.",
    "MIT reference to file": "Licensed under the MIT License (see LICENSE).",
    **{f"{x} tag": f"SPDX-License-Identifier: {x}" for x in licences.TAGGED},
}
VERBATIM = (
    "\n\nCopyright (C) 2007 Free Software Foundation, Inc. <https://fsf.org/>\nEveryone is permitted to copy and distribute "
    "verbatim copies\nof this license document, but changing it is not allowed."
)
GENUINE |= {
    "BSD-3-Clause": GENUINE["BSD-2-Clause"] + "\n\n3. Neither the name of the copyright holder nor the names of its\n   contributors "
    "may be used to endorse or promote products derived from\n   this software without specific prior written permission.",
    "AGPL-3.0-or-later": GENUINE["GPL-3.0-or-later"].replace("GNU General", "GNU Affero General"),
    "LGPL-2.1-or-later": GENUINE["GPL-3.0-or-later"].replace("program", "library").replace("GNU General", "GNU Lesser General").replace(
        "version 3", "version 2.1"
    ),
    "GPL-3.0 text": "GNU GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007" + VERBATIM,
    "GPL-2.0 text": "GNU GENERAL PUBLIC LICENSE\n   Version 2, June 1991" + VERBATIM,
    "AGPL-3.0 text": "GNU AFFERO GENERAL PUBLIC LICENSE\n   Version 3, 19 November 2007" + VERBATIM,
    "LGPL-3.0 text": "GNU LESSER GENERAL PUBLIC LICENSE\n   Version 3, 29 June 2007" + VERBATIM,
    "LGPL-2.1 text": "GNU LESSER GENERAL PUBLIC LICENSE\n   Version 2.1, February 1999" + VERBATIM,
}


def test_every_licence_is_found_in_its_genuine_text(spark):
    assert set(GENUINE) == set(licences.RULES)
    prefixes = ("", "# ", " * ", "// ", "; ", "! ", "dnl ", "REM ")
    rows = []
    for licence, text in GENUINE.items():
        for prefix in prefixes:
            commented = lambda t: "\n".join(f"{prefix}{x}".rstrip(" ") for x in t.split("\n"))
            rows.append((licence, commented(text)))
            rows.append((licence, commented(f"Copyright Some One\n{text}\n\nmore words").replace("\n", "\r\n")))
        # A title ends with its line, so it takes the line break.
        joined = " ".join(text.split()) if VERBATIM not in text else text
        rows.append((licence, f"words before\n\n{joined} words after"[: None if text.endswith(".") else -12]))
    rows.append((None, "This program is free.\nsoftware: you can redistribute it.\nNot licensed under the MIT license\nAll rights. reserved."))
    # A stop is no part of a known sentence that has none there.
    rows.append(("Apache-2.0 notice", "Licensed under the Apache License, Version 2.0.\n\nThe License\n\nfollows."))
    rows.append(("CC-BY-4.0", "Licensed under CC BY 4.0 International."))
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id bigint, text string")
    out = {r["doc_id"]: r["licences"] for r in rows_of(licences.scan(docs))}
    wrong = [(rows[i], found) for i, found in sorted(out.items()) if found != [x for x in rows[i][:1] if x]]
    assert not wrong and len(out) == len(rows)


def test_a_licence_that_begins_another_one(spark):
    """Two clauses count where a text has them without the third, also beside one that has it."""
    two, three = GENUINE["BSD-2-Clause"], GENUINE["BSD-3-Clause"]
    texts = [two, three, f"{three}\n\nand\n\n{two}", f"{two}\n\nand\n\n{three}", "SPDX-License-Identifier: MIT OR Apache-2.0"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    out = {r["doc_id"]: r["licences"] for r in rows_of(licences.scan(docs))}
    assert out[0] == ["BSD-2-Clause"] and out[1] == ["BSD-3-Clause"] and out[4] == []
    assert out[2] == ["BSD-2-Clause", "BSD-3-Clause"] == out[3]


def test_quality_of_odd_rows(docs):
    out = rows_of(quality.judge(docs))
    assert len(out) == len(TEXTS)
    null = next(r for r in out if r["doc_id"] == 3)
    assert null["n_words"] == 0 and null["base_failed"] and not null["kept"]


def test_pipeline(spark, docs):
    import corpus_pipeline

    assert len(corpus_pipeline.STAGES) == 5
    kept = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        before, kept = kept.columns, stage(spark, kept, SF_DIR)
        assert kept.columns == before
    assert corpus_pipeline.run(spark, SF_DIR).select("doc_id").distinct().count() == kept.select("doc_id").distinct().count()
