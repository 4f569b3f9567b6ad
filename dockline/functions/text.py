"""Job arguments and audit text."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import RUN_ARGUMENT

_VARIABLE = r"\{\{\s*([A-Za-z_]\w*)\s*\}\}"


def render_args(args: Column, context: Mapping[str, Column]) -> Column:
    """Fill ``{{ name }}`` in every argument; an unknown name is an error.

    Each argument is cut at its variables once, so a value that itself looks like
    a variable, or holds ``$`` or a backslash, stays as it is.
    """

    def lookup(name: Column) -> Column:
        unknown = F.raise_error(F.concat(F.lit("unknown template variable: "), name)).cast("string")
        known = (F.when(name == key, F.coalesce(value, F.lit(""))) for key, value in context.items())
        return F.coalesce(*known, unknown)

    def render(arg: Column) -> Column:
        names = F.regexp_extract_all(arg, F.lit(_VARIABLE), F.lit(1))
        # One more piece of literal text than there are variables.
        pieces = F.split(arg, _VARIABLE, -1)
        filled = F.zip_with(
            pieces,
            F.transform(names, lookup),
            lambda piece, value: F.concat(piece, F.coalesce(value, F.lit(""))),
        )
        return F.when(arg.rlike(_VARIABLE), F.array_join(filled, "")).otherwise(arg)

    return F.transform(args, render)


def set_arg(args: Column, value: Column, prefix: str = RUN_ARGUMENT) -> Column:
    """Drop every argument that starts with ``prefix`` and append the new one."""
    kept = F.filter(args, lambda arg: ~arg.startswith(prefix))
    return F.concat(kept, F.array(F.concat(F.lit(prefix), value)))


def upper_words(word: Column) -> Column:
    return F.upper(word)


def audit_json(**fields: Column) -> Column:
    """A record as JSON text without its NULL fields."""
    return F.to_json(F.struct(*(value.alias(name) for name, value in fields.items())))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda left, right: left & right, conditions)
