"""Host-level quality rules, in SQL functions only.

Every document is measured once: words, characters in words, symbols, lines that repeat an
earlier one, words in three-word windows that occur twice. Failures of each rule are
counted per host; a host's failure rate is shrunk towards the rate of all hosts by a beta
prior whose mean and strength are estimated from the hosts themselves (method of moments),
so hosts with few documents are not judged by them alone. A host fails if one of its
shrunk rates exceeds ``HOST_LIMIT``; its verdict is joined back to its documents.

``kept`` is false for documents that fail a base rule, and for those of failed hosts. Null
texts have no words. Rows without a host form one host of their own. An empty table gives
an empty result. Rows are never merged: repeated rows are judged, and counted, each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let, stored

WINDOW = 3
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
HOST_LIMIT = 0.5
# Bounds of the prior's strength, in documents.
WEAKEST, STRONGEST = 1.0, 1000.0


def words(text: Column) -> Column:
    return F.filter(F.split(F.translate(text, SPACES, " " * len(SPACES)), " "), lambda w: w != "")


def repeated_words(found: Column) -> Column:
    """Words that lie in a three-word window found twice or more; sorting finds the twins."""

    def windows(w: Column) -> Column:
        each = F.transform(w, lambda x, i: F.struct(F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))
        return F.sort_array(F.slice(each, F.lit(1), F.size(w) - (WINDOW - 1)))

    def twins(s: Column) -> Column:
        same = lambda x, k: F.coalesce(x["h"] == F.get(s, k)["h"], F.lit(False))
        found = F.filter(s, lambda x, k: same(x, k - 1) | same(x, k + 1))
        return F.sort_array(F.transform(found, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        gaps = F.transform(p, lambda x, j: F.least(F.lit(WINDOW), F.get(p, j + 1) - x))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    counted = let(let(windows(found), twins), covered)
    return F.when(F.size(found) >= WINDOW, counted).otherwise(0)


def measures(text: Column) -> dict[str, Column]:
    """The base measures of a text; ``w`` is bound once and used by two of them."""
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.translate(line, SPACES, "") != "")
    in_words = let(words(text), lambda w: F.struct(F.size(w).alias("n"), repeated_words(w).alias("r")))
    return {
        "_words": in_words,
        "word_chars": F.length(F.translate(text, SPACES, "")),
        "n_symbols": F.length(text) - F.length(F.translate(text, SYMBOLS, "")),
        "n_dup_lines": let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))),
    }


# Rules over a document's measures; the first two are the base.
RULES = {
    "short": f"n_words < {MIN_WORDS}",
    "repeats": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "lines": "n_dup_lines > 10 AND 10 * n_dup_lines > n_words",
}
BASE = ("short", "repeats")


def measured(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select("doc_id", F.col("source").alias("host"), *(c.alias(n) for n, c in measures(text).items()))
    rows = rows.select(
        "doc_id",
        "host",
        F.col("_words.n").cast("bigint").alias("n_words"),
        *(F.col(n).cast("bigint").alias(n) for n in ("word_chars", "n_symbols", "n_dup_lines")),
        F.col("_words.r").cast("bigint").alias("n_repeat_words"),
    )
    return rows.withColumns({f"fails_{name}": F.expr(rule) for name, rule in RULES.items()})


def failed_hosts(rows: DataFrame) -> DataFrame:
    """``host`` of hosts one of whose shrunk failure rates is above the limit."""
    hosts = stored(
        rows.groupBy("host").agg(
            F.count("*").alias("n"), *(F.sum(F.col(f"fails_{r}").cast("int")).alias(r) for r in RULES)
        ),
        "quality-hosts",
    )
    moments = hosts.agg(
        F.sum("n").alias("total"),
        *(F.sum(r).alias(r) for r in RULES),
        *(F.sum(F.col(r) * F.col(r) / F.col("n")).alias(f"square_{r}") for r in RULES),
    ).first()
    bad = F.lit(False)
    for rule in RULES:
        if not moments["total"]:
            break
        mu = moments[rule] / moments["total"]
        variance = moments[f"square_{rule}"] / moments["total"] - mu * mu
        strength = mu * (1 - mu) / variance - 1 if variance > 1e-12 else STRONGEST
        strength = min(max(strength, WEAKEST), STRONGEST)
        bad = bad | ((F.col(rule) + mu * strength) / (F.col("n") + strength) > HOST_LIMIT)
    return hosts.where(bad).select("host")


def judge(docs: DataFrame) -> DataFrame:
    """Measures, ``base_failed`` and ``kept`` of every document."""
    rows = stored(measured(docs), "quality-measures")
    hosts = failed_hosts(rows).select(F.col("host").alias("bad_host"), F.lit(True).alias("host_failed"))
    judged = rows.join(hosts, F.col("host").eqNullSafe(F.col("bad_host")), "left")
    base = F.greatest(*(F.col(f"fails_{r}") for r in BASE))
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base.alias("base_failed"),
        (~base & ~F.coalesce("host_failed", F.lit(False))).alias("kept"),
    )


_W = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"
SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT row, doc_id, host, text, {_W} AS w FROM d),
g AS (
  SELECT row, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i+2])) AS gram
  FROM w WHERE len(w) >= 3
),
t AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, gram) AS n FROM g) WHERE n > 1),
c AS (SELECT row, count(DISTINCT i + k) AS r FROM t, (VALUES (0), (1), (2)) AS s(k) GROUP BY row),
l AS (
  SELECT row, count(*) - count(DISTINCT line) AS n
  FROM (SELECT row, unnest(string_split(text, chr(10))) AS line FROM d)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row
),
m AS (
  SELECT doc_id, host, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.r, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN l USING (row) LEFT JOIN c USING (row)
),
f AS (SELECT *, {", ".join(f"({rule}) AS fails_{name}" for name, rule in RULES.items())} FROM m),
h AS (SELECT host, count(*) AS n, {", ".join(f"sum(fails_{r}::INT) AS {r}" for r in RULES)} FROM f GROUP BY host),
p AS (
  SELECT {", ".join(f"sum({r}) / sum(n) AS mu_{r}, sum({r} * {r} / n) / sum(n) - (sum({r}) / sum(n)) ** 2 AS var_{r}" for r in RULES)} FROM h
),
s AS (
  SELECT h.host, {" OR ".join(
      f"({r} + mu_{r} * k_{r}) / (n + k_{r}) > {HOST_LIMIT}" for r in RULES)} AS failed
  FROM h, (SELECT *, {", ".join(
      f"CASE WHEN var_{r} > 1e-12 THEN least(greatest(mu_{r} * (1 - mu_{r}) / var_{r} - 1, {WEAKEST}), {STRONGEST}) ELSE {STRONGEST} END AS k_{r}"
      for r in RULES)} FROM p)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       fails_short OR fails_repeats AS base_failed, NOT (fails_short OR fails_repeats) AND NOT s.failed AS kept
FROM f JOIN s ON f.host IS NOT DISTINCT FROM s.host
"""
