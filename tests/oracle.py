"""Run queries on Spark and their SQL on DuckDB, and compare the rows.

    python -m tests.oracle [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        db.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return db


def _value(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, pd.Timestamp):
        return value.to_pydatetime()
    if isinstance(value, (list, tuple)):
        return tuple(_value(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, _value(v)) for k, v in value.items()))
    if hasattr(value, "asDict"):
        return tuple(sorted((k, _value(v)) for k, v in value.asDict().items()))
    return value


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_value(row[i]) for i in order) for row in rows), key=repr)


def duck_rows(db, sql: str):
    cursor = db.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def compare(df, db, sql: str) -> str | None:
    """None when equal, else what differs."""
    columns, expected = duck_rows(db, sql)
    if sorted(df.columns) != sorted(columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    theirs = {row[0]: row[1] for row in db.execute(f"DESCRIBE {sql}").fetchall()}
    mine = {f.name: TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    if mine != theirs:
        return f"types {dict(mine.items() - theirs.items())} != {dict(theirs.items() - mine.items())}"
    mine, theirs = normal(df.columns, df.collect()), normal(columns, expected)
    if len(mine) != len(theirs):
        return f"{len(mine)} rows != {len(theirs)}"
    for a, b in zip(mine, theirs):
        if a != b:
            return f"{a} != {b}"
    return None


def main() -> int:
    from dockline.session import build_session

    import __spark_entry__ as contract

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = build_session("oracle", "local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(sf_dir), 0
    oracle = contract.oracle_sql()
    for name, run in contract.queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        started = time.time()
        try:
            df = run(spark, sf_dir)
            problem = compare(df, db, oracle[name]) if name in oracle else f"no SQL, {df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        ok = problem is None or problem.startswith("no SQL")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - started:.1f}s {problem or ''}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
