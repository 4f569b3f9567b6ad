"""Toxicity by a learned lexicon, misspellings included, and the windows around its terms.

*Lexicon.* Words whose documents are labelled toxic far more often than others, in at
least ``MIN_CONTEXTS`` different surroundings, so that copies of one text count once.

*Matching.* The lexicon's trie is intersected with the Levenshtein automaton of each term:
a state is the set of (trie node, edits) pairs that the letters read so far can have
reached. States are made when a word first needs them, so a word costs one step per letter
until it can no longer become a term. Terms of five letters or more may carry one edit,
of nine or more two. A word is letters and combining marks, when terms are learned and when
they are sought. Words joined by digits or ``@ $ *`` (``id1ot``) are also tried as one word if
none of them is a hit by itself, so that an edit can be spent on such a sign. Words of documents not labelled toxic are words of their own, not
misspellings, and do not match.

*Context.* A hit counts as quoted if it stands in a quotation of its line that opens at most
``WINDOW`` words before it and closes at most as many after it, otherwise as abuse; marks are
paired from the start of the line, however long that is. The densest window of abuse counts.

*Score.* A logistic model over binned counts of exact, misspelled and quoted hits and the
densest window. It is fitted on counts per bin, so what reaches the driver is bounded by
the number of bins.

The model holds the ``LEXICON_SIZE`` most telling terms and the ``OWN_WORDS`` most frequent
other words; both bound what a task keeps. It is fitted on at most ``FIT_ROWS`` labelled rows, those with the smallest hashes
among the rows of the training fold; everything else covers every row. Of rows that repeat
an id in ``labels`` the larger label counts; null labels are none. Without labels, or
without toxic ones, every score is 0. Null and empty texts have no hits and score as such.
Texts are read whole; the only inputs of a score are the text and the model.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import stored, table

# Bound of the labelled sample that the classifier is fitted on.
FIT_ROWS = 40_000
# Bound of the model: so many terms, the most telling first.
LEXICON_SIZE = 5_000
OWN_WORDS = 50_000
MIN_CONTEXTS = 6
# A term's documents are toxic at least so many times as often as the others, smoothed.
MIN_RATIO = 50.0
MIN_LETTERS = 3
WINDOW = 20
THRESHOLD = 0.3
RIDGE = 0.02
# A task remembers what it found for so many words.
MEMORY = 300_000


def _letters_and_marks(until: int) -> str:
    r"""The members of ``[\p{L}\p{M}]`` up to a code point as ranges of a Python character class."""
    ranges: list[list[int]] = []
    for code in range(until + 1):
        if unicodedata.category(chr(code))[0] in "LM":
            if ranges and ranges[-1][1] == code - 1:
                ranges[-1][1] = code
            else:
                ranges.append([code, code])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges)


class Patterns:
    """Words of texts without characters above a code point; the fewer ranges, the faster a space is told from a letter."""

    def __init__(self, until: int):
        letter = _letters_and_marks(until)
        self.letters = re.compile(f"[{letter}]+")
        # Signs that stand in for letters, and words that hold such.
        self.inside = re.compile(f"[0-9@$*](?=[{letter}])")
        self.mixed = re.compile(f"(?<![{letter}])[{letter}]++(?:[0-9@$*]++[{letter}]++)++")


ASCII, BASIC, ANY = Patterns(0x7F), Patterns(0xFFFF), Patterns(sys.maxunicode)
LETTERS = ANY.letters
BEYOND_BASIC = re.compile("[\U00010000-\U0010ffff]")
JAVA_LETTERS = r"[\p{L}\p{M}]+"
QUOTES = re.compile(r"[\"“”„«»‹›]")


def edits_allowed(length: int) -> int:
    return 0 if length < 5 else 1 if length < 9 else 2


@dataclass
class Automaton:
    """The trie of the terms with all their Levenshtein automata, made state by state."""

    terms: list[str]
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    ends: dict[int, int] = field(default_factory=dict)
    states: dict[frozenset, int] = field(default_factory=dict)
    steps: list[dict[str, int]] = field(default_factory=list)
    items: list[frozenset] = field(default_factory=list)
    verdicts: list[int] = field(default_factory=list)

    def __post_init__(self):
        self.most = [0]
        for term in self.terms:
            node, allowed = 0, edits_allowed(len(term))
            self.most[0] = max(self.most[0], allowed)
            for letter in term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.most.append(0)
                node = self.children[node][letter]
                # Edits are spent only where some term below still allows them.
                self.most[node] = max(self.most[node], allowed)
            self.ends[node] = allowed
        self.start = self._state({(0, 0)})

    def _state(self, reached: set[tuple[int, int]]) -> int:
        # A letter left out costs an edit and reads nothing.
        work = list(reached)
        while work:
            node, edits = work.pop()
            for child in self.children[node].values():
                if edits < self.most[child] and (child, edits + 1) not in reached:
                    reached.add((child, edits + 1))
                    work.append((child, edits + 1))
        least: dict[int, int] = {}
        for node, edits in reached:
            least[node] = min(edits, least.get(node, edits))
        key = frozenset(least.items())
        if key not in self.states:
            self.states[key] = len(self.items)
            self.items.append(key)
            self.steps.append({})
            found = [e for node, e in key if node in self.ends and e <= self.ends[node]]
            self.verdicts.append(0 if not found else 1 if min(found) == 0 else 2)
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        reached: set[tuple[int, int]] = set()
        for node, edits in self.items[state]:
            child = self.children[node].get(letter)
            if child is not None:
                reached.add((child, edits))
            if edits < self.most[node]:
                reached.add((node, edits + 1))
            for other in self.children[node].values():
                if edits < self.most[other]:
                    reached.add((other, edits + 1))
        to = self._state(reached) if reached else -1
        self.steps[state][letter] = to
        return to

    def match(self, word: str) -> int:
        """0 for no term, 1 for a term, 2 for a misspelled one."""
        state = self.start
        for letter in word:
            to = self.steps[state].get(letter)
            state = self._step(state, letter) if to is None else to
            if state < 0:
                return 0
        return self.verdicts[state]


class Memory(dict):
    """What the automaton says of words, the latest ``MEMORY`` or so of them."""

    def __init__(self, terms: list[str], own_words: list[str] = ()):
        super().__init__()
        self.automaton = Automaton(terms)
        self.own_words = frozenset(own_words)

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMORY:
            self.clear()
        if len(self.automaton.items) >= MEMORY:
            self.automaton = Automaton(self.automaton.terms)
        found = self.automaton.match(word)
        self[word] = found = 0 if found == 2 and word in self.own_words else found
        return found


def quoted(text: str, marks: list[int], spans: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether the hit stands in a quotation of its line that opens and closes within ``WINDOW`` words.

    ``marks`` are the places of all quotation marks, ``spans`` those of all words; marks are
    paired from the start of the line.
    """
    line, until = text.rfind("\n", 0, start) + 1, text.find("\n", end)
    opened, closed = bisect_left(marks, start), bisect_left(marks, end)
    if (opened - bisect_left(marks, line)) % 2 == 0 or closed == len(marks) or -1 < until < marks[closed]:
        return False
    place = lambda at: bisect_left(spans, (at,))
    return place(start) - place(marks[opened - 1]) <= WINDOW and place(marks[closed]) - place(end) <= WINDOW


def hits(text: str, memory: Memory) -> tuple[int, int, int, int]:
    """Abusive exact hits, abusive misspelled hits, quoted hits, most abuse in one window."""
    lowered = text.lower()
    patterns = ASCII if lowered.isascii() else ANY if BEYOND_BASIC.search(lowered) else BASIC
    words = patterns.letters.findall(lowered)
    found = list(map(memory.__getitem__, words))
    mixed = [m.span() for m in patterns.mixed.finditer(lowered) if memory[m.group()]] if patterns.inside.search(lowered) else []
    if not any(found) and not mixed:
        return 0, 0, 0, 0
    exact = near = cited = 0
    places: list[int] = []
    quotes = [m.start() for m in QUOTES.finditer(lowered)]
    spans = [m.span() for m in patterns.letters.finditer(lowered)] if quotes or mixed else None
    seen = [(at, found[at], spans[at] if quotes else None) for at in np.flatnonzero(np.array(found)).tolist()]
    for start, end in mixed:
        first, last = bisect_left(spans, (start,)), bisect_left(spans, (end,))
        if not any(found[first:last]):
            seen.append((first, memory[lowered[start:end]], (start, end)))
    for at, kind, span in sorted(seen, key=lambda hit: hit[0]):
        if quotes and quoted(lowered, quotes, spans, *span):
            cited += 1
            continue
        exact += kind == 1
        near += kind == 2
        places.append(at)
    spots = np.array(places)
    dense = int((np.searchsorted(spots, spots + WINDOW, "right") - np.arange(len(spots))).max()) if places else 0
    return exact, near, cited, dense


# Bins of the four counts: 0, 1, 2, 3-4, 5-8, 9 and more.
EDGES = (1, 2, 3, 5, 9)
FEATURES = ("exact", "near", "cited", "dense")


def _hit_columns(terms: list[str], own_words: list[str]):
    @pandas_udf("exact int, near int, cited int, dense int")
    def counted(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        memory = Memory(terms, own_words)
        for texts in parts:
            rows = [hits(t, memory) if t else (0, 0, 0, 0) for t in texts.tolist()]
            yield pd.DataFrame(np.array(rows, np.int32).reshape(-1, 4), columns=list(FEATURES))

    return counted


def binned(count: Column) -> Column:
    return sum((F.when(count >= edge, 1).otherwise(0) for edge in EDGES), F.lit(0))


@dataclass
class Model:
    terms: list[str]
    own_words: list[str]
    weights: list[float]

    def score(self, hits: Column) -> Column:
        total = F.lit(self.weights[0])
        for name, weight in zip(FEATURES, self.weights[1:]):
            total = total + binned(hits[name]) * F.lit(weight)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def hits(self, text: Column) -> Column:
        return _hit_columns(self.terms, self.own_words)(text)


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The labelled texts of the training fold that the model is fitted on."""
    marked = (
        labels.where(~held_out() & F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1))
        .groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS)
    # FIT_ROWS rows of two numbers: well below any broadcast limit.
    return stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text"), "toxicity-sample")


def _near(words: Column, terms: list[str]) -> Column:
    @pandas_udf("boolean")
    def near(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = Automaton(terms)
        for batch in parts:
            yield batch.map(lambda word: automaton.match(word) == 2)

    return near(words)


def learn_terms(sample: DataFrame) -> tuple[list[str], list[str]]:
    """Words of toxic documents that hardly any other document has, and words that only look like them."""
    words = F.transform(F.regexp_extract_all(F.lower("text"), F.lit(JAVA_LETTERS), F.lit(0)), lambda w: w)
    totals = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = totals.get(1, 0), totals.get(0, 0)
    if not bad:
        return [], []
    places = sample.where("toxic = 1").select(words.alias("w")).select("w", F.posexplode("w").alias("i", "word"))
    around = F.xxhash64(F.get("w", F.col("i") - 1), F.get("w", F.col("i") + 1))
    seen = (
        places.where(F.length("word") >= MIN_LETTERS)
        .select("word", around.alias("around"))
        .distinct()
        .groupBy("word")
        .agg(F.count("*").alias("contexts"))
        .where(F.col("contexts") >= MIN_CONTEXTS)
    )
    seen = stored(seen, "toxicity-words")
    counts = (
        sample.select("toxic", F.explode(F.array_distinct(words)).alias("word"))
        .groupBy("word")
        .agg(F.sum("toxic").alias("bad"), F.sum(1 - F.col("toxic")).alias("good"))
    )
    counts = stored(counts, "toxicity-counts")
    ratio = (F.least("bad", "contexts") + 0.5) / (bad + 1.0) / ((F.col("good") + 0.5) / (good + 1.0))
    best = counts.join(seen, "word").withColumn("ratio", ratio).where(F.col("ratio") >= MIN_RATIO)
    terms = [r["word"] for r in best.orderBy(F.desc("ratio"), "word").limit(LEXICON_SIZE).collect()]
    own = counts.where("good > 0").where(_near(F.col("word"), terms))
    return terms, [r["word"] for r in own.orderBy(F.desc("good"), "word").limit(OWN_WORDS).collect()]


def fit_weights(rows: np.ndarray) -> list[float]:
    """Ridge logistic regression by Newton steps over ``(bins..., label, count)`` rows."""
    x = np.column_stack([np.ones(len(rows)), rows[:, :-2].astype(float)])
    y, n = rows[:, -2].astype(float), rows[:, -1].astype(float)
    w = np.zeros(x.shape[1])
    penalty = RIDGE * n.sum() * np.diag([0.0, *np.ones(x.shape[1] - 1)]) / 100
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (y - p)) - penalty @ w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + penalty + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return w.tolist()


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    sample = _sample(docs, labels)
    terms, own_words = learn_terms(sample)
    if not terms:
        return Model([], [], [-30.0, 0.0, 0.0, 0.0, 0.0])
    # Weights come from texts that the lexicon behind them has not seen.
    half = F.xxhash64("text") % 2 == 0
    known = learn_terms(sample.where(half))
    found = sample.where(~half).select("toxic", _hit_columns(*known)("text").alias("h"))
    bins = [binned(F.col("h")[name]).alias(name) for name in FEATURES]
    counts = found.select(*bins, "toxic").groupBy(*FEATURES, "toxic").agg(F.count("*").alias("n"))
    rows = counts.orderBy(*FEATURES, "toxic").collect()
    if not rows:
        return Model([], [], [-30.0, 0.0, 0.0, 0.0, 0.0])
    return Model(terms, own_words, fit_weights(np.array([tuple(r) for r in rows])))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and the counts of every document."""
    model = fit(docs, labels)
    found = docs.select("doc_id", model.hits(F.col("text")).alias("h"))
    scored = found.withColumn("score", model.score(F.col("h")))
    return scored.select(
        "doc_id",
        held_out().alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        *(F.col("h")[name].alias(f"n_{name}") for name in FEATURES),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents scored as toxic."""
    model = fit(docs, labels)
    scored = docs.withColumn("_dl_hits", model.hits(F.col("text")))
    return scored.where(model.score(F.col("_dl_hits")) < THRESHOLD).drop("_dl_hits")


def labels_of(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels")
