"""Translators for the textual options of a load (driver side, one value each)."""

from __future__ import annotations

import re

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "integer": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
}

_CODE_POINT = re.compile(r"(?i)^(?:u\+(?P<u>[0-9a-f]+)|0x(?P<x>[0-9a-f]+)|0o(?P<o>[0-7]+)|0b(?P<b>[01]+))$")
_BASES = {"u": 16, "x": 16, "o": 8, "b": 2}


def parse_separator(text: str) -> str:
    """``','``, ``'u+0001'``, ``'0x01'``, ``'0o1'`` or ``'0b1'`` to one character."""
    match = _CODE_POINT.match(text)
    if match:
        kind = match.lastgroup
        return chr(int(match[kind], _BASES[kind]))
    if len(text) != 1:
        raise ValueError(f"separator must be one character or a code point, got {text!r}")
    return text


def parse_schema(text: str) -> T.StructType:
    """``'a:int, b:string'`` to a schema of nullable columns."""
    fields = []
    for item in text.split(","):
        name, colon, kind = (part.strip() for part in item.partition(":"))
        if not (name and colon):
            raise ValueError(f"expected name:type, got {item.strip()!r}")
        if kind.lower() not in _TYPES:
            raise ValueError(f"unsupported type {kind!r} of column {name!r}")
        fields.append(T.StructField(name, _TYPES[kind.lower()], nullable=True))
    return T.StructType(fields)


# strptime directives a partition format may use, as Spark datetime patterns.
_DIRECTIVES = {
    "Y": "yyyy",
    "m": "MM",
    "d": "dd",
    "H": "HH",
    "M": "mm",
    "S": "ss",
    "f": "SSSSSS",
    "j": "DDD",
    "b": "MMM",
}


def spark_datetime_pattern(strptime_format: str) -> str:
    """``'%Y-%m-%d'`` to ``'yyyy-MM-dd'``.

    A format without a year is refused: its default year would differ between
    engines and put rows into a partition nobody asked for.
    """
    out: list[str] = []
    literal = ""
    tokens = re.findall(r"%.|[^%]+|%$", strptime_format, flags=re.S)
    for token in [*tokens, ""]:
        if token.startswith("%") and token != "%%":
            if token[1:] not in _DIRECTIVES:
                raise ValueError(f"unsupported directive {token} in {strptime_format!r}")
            out.append(_quote(literal) + _DIRECTIVES[token[1:]])
            literal = ""
        else:
            literal += token.replace("%%", "%")
    out.append(_quote(literal))
    if not any(part.endswith("yyyy") for part in out):
        raise ValueError(f"partition format {strptime_format!r} has no year")
    return "".join(out)


def _quote(literal: str) -> str:
    if re.fullmatch(r"[-/:., _]*", literal):
        return literal
    return "'" + literal.replace("'", "''") + "'"


def java_regex(pattern: str, need_group: bool = False) -> str:
    """A Python regular expression in the dialect of the JVM."""
    compiled = re.compile(pattern)
    if need_group and compiled.groups < 1:
        raise ValueError(f"{pattern!r} needs a capture group")
    return translated_regex(pattern)


def translated_regex(pattern: str) -> str:
    """Named groups and references as the JVM writes them; the rest is taken as it is."""
    return re.sub(r"\(\?P=(\w+)\)", r"\\k<\1>", pattern.replace("(?P<", "(?<"))


def has_wildcards(path: str | None) -> bool:
    return bool(path) and ("*" in path or "?" in path)


def glob_regex(pattern: str, cross_slash: bool = True) -> str:
    """A shell pattern as an anchored regular expression.

    ``cross_slash`` lets ``*`` and ``?`` run over ``/`` (whole-path matching);
    without it they stay inside one path segment.
    """
    anything, single = (".", ".") if cross_slash else ("[^/]", "[^/]")
    out = []
    position = 0
    while position < len(pattern):
        char = pattern[position]
        position += 1
        if char == "*":
            out.append(f"{anything}*")
        elif char == "?":
            out.append(single)
        elif char == "[":
            negated = pattern[position : position + 1] == "!"
            start = position + negated
            # A bracket right after the opening one is a member of the class.
            end = pattern.find("]", start + 1)
            if end < 0:
                out.append(r"\[")
                continue
            members = re.sub(r"([\\\[\]&^])", r"\\\1", pattern[start:end])
            out.append(f"[{'^' if negated else ''}{members}]")
            position = end + 1
        else:
            out.append(char if char.isalnum() or char in "_/ -" else "\\" + char)
    return f"(?s)^{''.join(out)}\\z"
