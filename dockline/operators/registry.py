"""Integrity checks that hold for any pair of tables, rule registries included."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from ..functions.durations import iso_duration_micros


def fk_violations(child: DataFrame, parent: DataFrame, keys: dict[str, str]) -> DataFrame:
    """Child rows whose key (child column to parent column) has no parent.

    The parent is reduced to its keys; a NULL key is a violation.
    """
    wanted = parent.select(*(F.col(p).alias(f"_parent_{p}") for p in keys.values())).distinct()
    condition = [F.col(c) == F.col(f"_parent_{p}") for c, p in keys.items()]
    return child.join(wanted, condition, "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def key_intersection(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys defined on both sides, each reduced before it is shuffled."""
    return left.select(*keys).distinct().intersect(right.select(*keys).distinct())


def registry_union(common: DataFrame, own: DataFrame) -> DataFrame:
    """Both registries; check ``key_intersection`` first."""
    return common.unionByName(own)


def union_evolving(older: DataFrame, newer: DataFrame) -> DataFrame:
    """Rows of both, where either side may lack columns of the other."""
    return older.unionByName(newer, allowMissingColumns=True)


def first_match(df: DataFrame, keys: Sequence[str], ordinal: str, columns: Sequence[str]) -> DataFrame:
    """Per key, the row that comes first in registry order."""
    row = F.min_by(F.struct(*columns), F.col(ordinal))
    return df.groupBy(*keys).agg(row.alias("_row")).select(*keys, "_row.*")


@pandas_udf(T.StringType())
def pattern_error(patterns: pd.Series) -> pd.Series:
    """What keeps a regular expression from being one; NULL if nothing does."""

    def error(pattern: str | None) -> str | None:
        try:
            re.compile(pattern or "")
        except re.error as e:
            return str(e)
        return None

    return patterns.map(error)


def check_rules(
    rules: DataFrame,
    clusters: DataFrame,
    required: Sequence[str],
    domains: dict[str, Sequence[str]],
    patterns: Sequence[str] = (),
    durations: Sequence[str] = (),
    known: Sequence[str] | None = None,
) -> DataFrame:
    """All findings about a rule registry: ``name, finding``.

    Missing fields, values outside their domain, ``patterns`` that are no regular
    expressions, ``durations`` that are no ISO durations, filled columns that are not
    ``known`` (if given), duplicate names, and references to clusters that do not exist.
    """

    def invalid(c: str) -> Column:
        return F.concat(F.lit(f"invalid:{c}="), F.col(c))

    checks = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in required]
    checks += [
        F.when(F.col(c).isNotNull() & ~F.col(c).isin(list(allowed)), invalid(c)) for c, allowed in domains.items()
    ]
    checks += [F.when(pattern_error(F.col(c)).isNotNull(), invalid(c)) for c in patterns]
    checks += [F.when(F.col(c).isNotNull() & iso_duration_micros(F.col(c)).isNull(), invalid(c)) for c in durations]
    if known is not None:
        checks += [F.when(F.col(c).isNotNull(), F.lit(f"unknown:{c}")) for c in rules.columns if c not in known]
    findings = F.array_compact(F.array(*checks).cast("array<string>"))
    rows = rules.select("name", F.explode(findings).alias("finding"))
    duplicates = duplicate_keys(rules, ["name"]).select("name", F.lit("duplicate name").alias("finding"))
    dangling = fk_violations(rules, clusters, {"cluster_blueprint_name": "name"}).select(
        "name", F.concat(F.lit("unknown cluster: "), F.coalesce("cluster_blueprint_name", F.lit("NULL"))).alias("finding")
    )
    return rows.unionByName(duplicates).unionByName(dangling)


def sorted_paths(df: DataFrame, path: str) -> DataFrame:
    return df.select(F.col(path).alias("path")).distinct().orderBy("path")


def path_set(df: DataFrame, path: Column) -> DataFrame:
    return df.select(path.alias("path")).distinct()
