"""Personal data by candidate gradient boosting, in SQL functions only.

*Generators* propose spans per kind, with high recall and freely overlapping: the four base
kinds, and national phone numbers, social security numbers, IBANs and spelled-out e-mail
addresses. A proposal of a base kind that passes its format is a base span and stays.

*Features* of a proposal, all with few levels: its kind, the characters around it,
whether a cue word stands shortly before it, its separators, its digit groups and its
variety of digits.

*Boosting.* Trees are fitted on the counts of feature vectors over the proposals of all kinds
that have evidence; see :mod:`boosting`. Evidence is the format check of ip, card, phone and
IBAN, numbers that are given out for social security and national phone numbers, and the form
of the domain for spelled-out addresses: where such proposals are chance, the share with
evidence falls to that of chance, which is below ``PRECISION``. A number that fails as a card
and overlaps another kind's proposal says nothing and is left out. Each kind has a threshold
of its own, calibrated to a precision of ``PRECISION``; a proposal of an added kind from there
on becomes a span, if it overlaps no base span and no earlier added one.

Null texts count as empty and have no spans. Offsets count code points, ends are exclusive.
Every row gives one row, ties of start are ordered by kind, an empty table gives an empty
result, and other columns are ignored or, in ``redact``, kept.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .boosting import Boosted, boost, threshold
from .common import let, stored

PRECISION = 0.9
CONTEXT = 32

# The base patterns. Possessive repeats and the look at the end of the last match (\G) match
# what the plain patterns match, without recursion and without rescanning long runs.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ADDED = {
    "national": r"(?<![\w+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![\w-])",
    "ssn": r"(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
    "iban": r"(?<!\w)[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?!\w)",
    "spelled": rf"(?i){_LOCAL}{{1,64}}\x20?(?:\(at\)|\[at\])\x20?[a-z0-9-]{{1,63}}\x20?(?:\(dot\)|\[dot\]|\.)\x20?[a-z]{{2,24}}(?!\w)",
}
PATTERNS = BASE | ADDED
KINDS = list(PATTERNS)
# What a text must hold for a pattern to match at all.
NEEDS = {"email": "@", "phone": r"\+[0-9]", "spelled": r"(?i)[(\[]at[)\]]"} | {
    k: "[0-9]" for k in ("ip", "card", "national", "ssn", "iban")
}
CUES = r"(?i)(?:mail|tel|phone|fon|call|mobil|card|karte|carte|tarjeta|konto|account|ssn|social|iban|\bip\b|addr|contact)[^\n]{0,16}$"


def digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(number: Column) -> Column:
    def term(i: Column) -> Column:
        digit = F.substring(number, -i, F.lit(1)).cast("int")
        twice = digit * 2
        return F.when(i % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    places = F.sequence(F.lit(1), F.greatest(F.length(number), F.lit(1)))
    return F.aggregate(places, F.lit(0), lambda total, i: total + term(i)) % 10 == 0


def mod97(match: Column) -> Column:
    """The check of an IBAN: its country and check digits moved last, letters as 10 to 35."""
    plain = F.regexp_replace(match, r"\x20", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    step = lambda rest, c: (F.when(c.between("0", "9"), rest * 10).otherwise(rest * 100) + value(c)) % 97
    return F.aggregate(F.split(turned, "(?!$)"), F.lit(0), step) == 1


def passes(kind: str, match: Column) -> Column:
    """The format check of a kind; for the last three of the added kinds it is all they have."""
    if kind == "ip":
        small = lambda part: F.length(F.ltrim(part, F.lit("0"))) <= 3
        value = lambda part: F.right(part, F.lit(3)).cast("int") <= 255
        return F.forall(F.split(match, r"\."), lambda part: small(part) & value(part))
    if kind == "card":
        return let(digits(match), lambda d: F.when(F.length(d).between(14, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(digits(match)).between(10, 15)
    if kind == "iban":
        return mod97(match)
    return F.lit(True)


def evidence(kind: str, match: Column) -> Column:
    """What a proposal's truth is learned from: its format, or a form that chance often misses."""
    if kind == "ssn":
        return ~match.rlike(r"^(?:000|666|9)|-00-|-0000$")
    if kind == "national":
        return match.rlike(r"^\(?[2-9][0-9]{2}\)?[\x20.-][2-9]")
    if kind == "spelled":
        domain = r"(?i)[)\]]\x20?[a-z0-9](?:[a-z0-9-]*[a-z0-9])?\x20?"
        return match.rlike(
            domain + r"(?:[(\[]dot[)\]]\x20?[a-z]{2,24}|\.\x20?(?:com|org|net|edu|gov|int|mil|info|biz|name|example|[a-z]{2}))$"
        )
    return passes(kind, match)


def _edge(character: Column) -> Column:
    """0 for none or white space, 1 for a punctuation mark, 2 for a letter or digit."""
    return F.when(character.rlike(r"[\p{L}\p{N}]"), 2).when(character.rlike(r"\S"), 1).otherwise(0)


FEATURES = ("kind", "before", "after", "cued", "separated", "groups", "variety", "size")


def _features(kind: str, match: Column, before: Column, after: Column) -> Column:
    number = digits(match)
    groups = F.regexp_count(match, F.lit("[0-9]+"))
    variety = F.size(F.array_distinct(F.split(number, "(?!$)")))
    return F.struct(
        F.lit(KINDS.index(kind)).alias("kind"),
        _edge(F.right(before, F.lit(1))).alias("before"),
        _edge(F.left(after, F.lit(1))).alias("after"),
        F.right(before, F.lit(CONTEXT)).rlike(CUES).cast("int").alias("cued"),
        match.rlike(r"[\x20().-]").cast("int").alias("separated"),
        F.least(groups, F.lit(5)).alias("groups"),
        F.least(variety, F.lit(6)).alias("variety"),
        F.when(F.length(number) < 9, 0).when(F.length(number) < 14, 1).when(F.length(number) < 20, 2).otherwise(3).alias("size"),
    )


_NO_SPANS = (
    "array<struct<start:int,kind_rank:int,end:int,good:boolean,likely:boolean,"
    "f:struct<kind:int,before:int,after:int,cued:int,separated:int,groups:int,variety:int,size:int>>>"
)


def _proposed(text: Column, kind: str) -> Column:
    """The proposals of one kind: pieces between matches and matches give the offsets."""
    pattern = F.lit(PATTERNS[kind])

    def placed(both: Column) -> Column:
        pieces, matches = both["pieces"], both["matches"]
        lengths = F.zip_with(pieces, matches, lambda p, m: F.struct(F.length(p).alias("p"), F.length(m).alias("m")))
        begin = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        starts = F.aggregate(
            F.slice(lengths, F.lit(1), F.size(matches)),
            begin,
            lambda acc, x: F.struct(
                (acc["at"] + x["p"] + x["m"]).alias("at"), F.array_append(acc["starts"], acc["at"] + x["p"]).alias("starts")
            ),
            lambda acc: acc["starts"],
        )
        return F.transform(
            F.arrays_zip(starts.alias("s"), matches.alias("m")),
            lambda x, i: F.struct(
                x["s"].alias("start"),
                F.lit(KINDS.index(kind)).alias("kind_rank"),
                (x["s"] + F.length(x["m"])).alias("end"),
                passes(kind, x["m"]).alias("good"),
                evidence(kind, x["m"]).alias("likely"),
                _features(kind, x["m"], F.get(pieces, i), F.get(pieces, i + 1)).alias("f"),
            ),
        )

    both = F.struct(F.split(text, PATTERNS[kind], -1).alias("pieces"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("matches"))
    found = F.when(text.rlike(PATTERNS[kind]), let(both, placed))
    return F.coalesce(F.when(text.rlike(NEEDS[kind]), found), F.array().cast(_NO_SPANS))


def proposals(text: Column) -> Column:
    """All proposals of a text, by start and kind; single digits and the like are left out."""
    text = F.coalesce(text, F.lit(""))
    parts = F.concat(*(_proposed(text, kind) for kind in KINDS))
    worth = F.filter(parts, lambda s: s["good"] | (s["end"] - s["start"] >= 7))
    return F.when(text.rlike(r"[0-9@]|[(\[][aA][tT][)\]]"), F.sort_array(worth)).otherwise(F.array().cast(_NO_SPANS))


def _telling(spans: Column) -> Column:
    """Proposals that count in the fit: all but addresses, and card failures that another kind may explain."""
    card, email = KINDS.index("card"), KINDS.index("email")
    others = F.filter(spans, lambda s: s["kind_rank"] != card)
    failed = lambda s: (s["kind_rank"] == card) & ~s["good"]
    explained = lambda s: F.exists(others, lambda o: (o["start"] < s["end"]) & (s["start"] < o["end"]))
    return F.filter(spans, lambda s: (s["kind_rank"] != email) & F.when(failed(s), ~explained(s)).otherwise(True))


def fit(spans: DataFrame) -> tuple[Boosted, list[float]]:
    """Trees, and the threshold of each kind, from the proposals with evidence for or against them."""
    each = spans.select(F.explode(_telling(F.col("spans"))).alias("s"))
    counts = each.groupBy(*(F.col(f"s.f.{f}").alias(f) for f in FEATURES)).agg(
        F.count("*").alias("n"), F.sum(F.col("s.likely").cast("int")).alias("good")
    )
    # At most the product of the levels, some 50,000 rows.
    rows = np.array([tuple(r) for r in counts.orderBy(*FEATURES).collect()], np.float64)
    if not len(rows):
        return Boosted(-30.0, []), [2.0] * len(KINDS)
    x, n, good = rows[:, :-2], rows[:, -2], rows[:, -1]
    model = boost(x, good, n)
    p = 1 / (1 + np.exp(-model.margin(x)))
    # An IBAN must pass its check as well, which one in 97 of chance does.
    n = np.where(x[:, 0] == KINDS.index("iban"), good + (n - good) / 96, n)
    own = [x[:, 0] == rank for rank in range(len(KINDS))]
    return model, [threshold(p[k], good[k], n[k], PRECISION) for k in own]


def selected(spans: Column, model: Boosted, least: list[float]) -> Column:
    """Base spans, and added ones of a sufficient score that overlap none before them."""
    base = F.filter(spans, lambda s: s["good"] & (s["kind_rank"] < len(BASE)))
    score = lambda s: model.column([s["f"][name] for name in FEATURES])
    # Scores are summed in another order here than in the fit.
    bounds = F.array(*(F.lit(float(p) - 1e-9) for p in least))
    enough = lambda s: score(s) >= F.get(bounds, s["kind_rank"])
    added = F.filter(spans, lambda s: s["good"] & (s["kind_rank"] >= len(BASE)) & enough(s))
    apart = F.filter(
        added, lambda s: ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    )
    none = F.array().cast(_NO_SPANS)

    def step(acc: Column, s: Column) -> Column:
        free = s["start"] >= acc["at"]
        end = F.when(free, s["end"]).otherwise(acc["at"])
        return F.struct(end.alias("at"), F.when(free, F.concat(acc["kept"], F.array(s))).otherwise(acc["kept"]).alias("kept"))

    # A span gives way only to one that stays itself.
    begin = F.struct(F.lit(0).alias("at"), F.filter(apart, lambda s: F.lit(False)).alias("kept"))
    alone = F.aggregate(F.sort_array(apart), begin, step, lambda acc: acc["kept"])
    return F.when(F.size(spans) > 0, F.sort_array(F.concat(base, alone))).otherwise(none)


def _named(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    each = F.transform(
        spans,
        lambda s: F.concat_ws(":", F.get(names, s["kind_rank"]), s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.concat_ws(",", each)


def find(docs: DataFrame) -> DataFrame:
    """Counts of base spans, their digest, and all spans of every document."""
    rows = stored(docs.select("doc_id", proposals(F.col("text")).alias("spans")), "pii-proposals")
    model, least = fit(rows)
    rows = rows.withColumn("chosen", selected(F.col("spans"), model, least))
    base = F.filter("chosen", lambda s: s["kind_rank"] < len(BASE))
    # A function of its own: a lambda's second parameter would be the index of an element.
    number = lambda rank: F.size(F.filter("chosen", lambda s: s["kind_rank"] == rank)).cast("bigint")
    counts = [number(rank).alias(f"n_{kind}") for rank, kind in enumerate(BASE)]
    return rows.select("doc_id", *counts, F.sha2(_named(base), 256).alias("base_sha256"), _named(F.col("chosen")).alias("spans"))


def _redacted(text: Column, spans: Column) -> Column:
    """``text`` with every span replaced by its kind in angle brackets; overlaps by the first."""
    names = F.array(*(F.lit(f"<{k.upper()}>") for k in KINDS))

    def step(acc: Column, s: Column) -> Column:
        part = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.get(names, s["kind_rank"]))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], part)).otherwise(acc["out"]).alias("out"),
        )

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    done = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, begin, step, done)).otherwise(text)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with personal data in ``text`` replaced, and ``n_chars`` (if any) counted anew there."""
    model, least = fit(docs.select(proposals(F.col("text")).alias("spans")))
    marked = docs.withColumn("_dl_spans", proposals(F.col("text")))
    marked = marked.withColumn("_dl_spans", selected(F.col("_dl_spans"), model, least))
    new = {"text": _redacted(F.col("text"), F.col("_dl_spans"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size("_dl_spans") > 0, F.length(new["text"])).otherwise(F.col("n_chars"))
    return marked.select(*(new[c].alias(c) if c in new else F.col(c) for c in docs.columns))
