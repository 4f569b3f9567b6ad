"""Every query of the driver contract, with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dockline.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, and its SQL if it has one."""

    def register(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is defined twice")

        def configured(spark: SparkSession, sf_dir: str) -> DataFrame:
            return run(configure(spark), sf_dir)

        QUERIES[name] = configured
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


def load_all() -> None:
    from . import admission, loads, paths, predicates, registry, routing, scalars, scans, streams  # noqa: F401
