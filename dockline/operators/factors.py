"""Literal pieces of regular expressions, as keys to look matching names up by.

A name matches a pattern only if it holds every *factor* of it: text outside of
repetition, choice, classes and anchors. Each pattern gets one key, the run of
characters of its factors that the fewest patterns have; a name has all its runs.
Runs are long where a factor is, since the patterns that share a short one grow with
the registry. Patterns that cannot be read with certainty get no key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GRAM = 4
# Lengths of runs; a pattern takes the first that one of its factors has.
SIZES = (8, GRAM)
# Groups within groups are opened up to this depth.
DEPTH = 6

# Stand for "anything may follow here" and for a literal dot.
_GAP, _DOT = "\x01", "\x02"

# Choice, flags, look-around, named backreferences, escapes with an argument, quotations,
# and classes within classes.
_UNCERTAIN = r"(?s)[|\x01\x02]|\(\?|\\[^WwDdSsbBAZz./_\x20:;,=@#%&~'\"<>!$^()\[\]{}*+?\\-]|\[[^\]]*\[|&&"
_REPEATED = r"(?:[*?]|\{[^{}]*\})[?+]?"


def _opened(pattern: Column) -> Column:
    """Innermost groups without their parentheses; repeated ones may occur any number of times."""
    gone = F.regexp_replace(pattern, rf"\([^()]*\){_REPEATED}", _GAP)
    once = F.regexp_replace(gone, r"\(([^()]*)\)\+[?+]?", f"{_GAP}$1{_GAP}")
    # One that became innermost only now may be repeated: the next turn sees to it.
    return F.regexp_replace(once, r"\(([^()]*)\)(?![*?+{])", "$1")


def literal_factors(pattern: Column) -> Column:
    """Texts that every match of a pattern contains; empty if none is certain."""
    plain = F.regexp_replace(pattern, r"\(\?(?::|P?<[A-Za-z_]\w*>)", "(")
    text = F.regexp_replace(plain, r"\\\.", _DOT)
    text = F.regexp_replace(text, r"\\([/_\x20:;,=@#%&~'\"<>!-])", "$1")
    text = F.regexp_replace(text, r"(?s)\\.", _GAP)
    text = F.regexp_replace(text, r"\[\^?\]?[^\]]*\]", _GAP)
    for _ in range(DEPTH):
        text = _opened(text)
    text = F.regexp_replace(text, rf"(?s).{_REPEATED}", _GAP)
    text = F.regexp_replace(text, r"(?s)(.)\+[?+]?", f"$1{_GAP}")
    text = F.regexp_replace(text, "[.^$]", _GAP)
    factors = F.filter(F.split(F.replace(text, F.lit(_DOT), F.lit(".")), _GAP), lambda piece: piece != "")
    unread = plain.rlike(_UNCERTAIN) | text.rlike(r"[()\[\]{}*+?\\]")
    return F.when(pattern.isNull() | unread, F.array().cast("array<string>")).otherwise(factors)


def grams(text: Column, size: int = GRAM) -> Column:
    """All runs of ``size`` characters of a text, each once."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1))
    runs = F.transform(starts, lambda start: F.substring(text, start, F.lit(size)))
    return F.array_distinct(F.coalesce(runs, F.array().cast("array<string>")))


def run_size(factors: Column) -> Column:
    """The length of the runs taken from a pattern's factors; null if there are none."""
    longest = F.array_max(F.transform(factors, F.length))
    return F.coalesce(*(F.when(longest >= size, F.lit(size)) for size in SIZES))


def _runs(factors: Column, size: int) -> Column:
    return F.array_distinct(F.flatten(F.transform(factors, lambda factor: grams(factor, size))))


def rarest_grams(patterns: DataFrame, pattern: str, group: str) -> DataFrame:
    """``group, pattern, gram``: the run that the fewest patterns of a group have, if there is any."""
    listed = patterns.select(group, pattern).distinct().withColumn("_factors", literal_factors(F.col(pattern)))
    size, factors = run_size(F.col("_factors")), F.col("_factors")
    runs = F.coalesce(*(F.when(size == n, _runs(factors, n)) for n in SIZES))
    held = listed.select(group, pattern, F.explode(runs).alias("gram"))
    sizes = held.groupBy(group, "gram").agg(F.count(F.lit(1)).alias("_holders"))
    ranked = held.join(sizes, [group, "gram"])
    return ranked.groupBy(group, pattern).agg(F.min_by("gram", F.struct("_holders", "gram")).alias("gram"))
