"""Headline timings, one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Input files are laid out first and are not timed. Every query runs once to warm up
and then three times; the median counts. Each timed run computes its whole result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from catalog.admission import DAY, narrow, run  # noqa: E402
from catalog.fixtures import (  # noqa: E402
    ORDERS_TEXT_SCHEMA,
    dated_files,
    flat_orders,
    objects,
    rules,
    strip_extensions,
    table,
)
from catalog.paths import probes  # noqa: E402
from catalog.routing import user_objects  # noqa: E402
from dockline.operators.classify import classify_paths  # noqa: E402
from dockline.operators.routing import match_pairs, route_events  # noqa: E402
from dockline.plans.load import LoadSpec, run_load  # noqa: E402
from dockline.session import build_session, scratch  # noqa: E402
from dockline.sinks.table import TableSpec  # noqa: E402
from dockline.sources.scan import scan  # noqa: E402

ROUNDS = 3


def drain(df) -> None:
    """Compute every column of every row without keeping any."""
    df.write.format("noop").mode("overwrite").save()


def written(df) -> str:
    """A copy in as many files as there are tasks; the given tables are one file each."""
    spark = df.sparkSession
    path = scratch(spark, "input")
    df.repartition(spark.sparkContext.defaultParallelism).write.parquet(path)
    return path


def folder_rules(spark, count: int):
    """``count`` rules, one per user folder and event type."""
    kinds = F.array(*(F.lit(k) for k in ("click", "view", "purchase", "error", "signup")))
    return spark.range(count).select(
        F.col("id").alias("ordinal"),
        F.concat(F.lit("rule-"), F.col("id").cast("string")).alias("name"),
        F.concat(F.lit("b"), (F.floor(F.col("id") / 5) % 7).cast("string")).alias("source_bucket"),
        F.concat(
            F.lit("^u"),
            F.floor(F.col("id") / 5).cast("string"),
            F.lit("/"),
            F.element_at(kinds, (F.col("id") % 5 + 1).cast("int")),
            F.lit(r"/\d{8}/part-[0-2]\.json$"),
        ).alias("source_prefix"),
        F.lit("file").alias("mode"),
        F.lit(True).alias("auto_trigger"),
    )


def benches(spark, sf_dir: str):
    lineitem = table(spark, sf_dir, "lineitem")
    months = dated_files(lineitem, "l_shipdate", "yyyyMM", "parquet")
    plain = flat_orders(spark, sf_dir, "csv", sep="|")
    packed = flat_orders(spark, sf_dir, "csv", compression="gzip")
    unnamed = strip_extensions(spark, flat_orders(spark, sf_dir, "csv", compression="gzip"))
    target = scratch(spark, "table")
    load = dict(
        job="lineitem",
        fmt="parquet",
        partition_regex=r"^/(\d{6})/",
        partition_format="%Y%m",
        path_root="/daily/data",
        table=TableSpec(path=target, granularity="MONTH"),
    )
    few, many = folder_rules(spark, 100), folder_rules(spark, 10_000)
    events = spark.read.parquet(written(user_objects(spark, sf_dir)))
    uploads = spark.read.parquet(written(objects(spark, sf_dir)))
    asked = spark.read.parquet(written(probes(spark, sf_dir)))
    text = dict(fmt="delimited", schema=ORDERS_TEXT_SCHEMA)
    visits = spark.read.parquet(written(narrow(spark, sf_dir)))
    return {
        "overwrite_table": lambda n: run_load(spark, LoadSpec(**load), months, f"t{n}"),
        "overwrite_partition_range": lambda n: run_load(
            spark, LoadSpec(**load, mode="partition_range"), f"{months}/1997*", f"r{n}"
        ),
        "scan_delimited": lambda n: drain(scan(spark, plain, delimiter="|", **text)),
        "scan_compressed": lambda n: drain(scan(spark, packed, delimiter=",", **text)),
        "scan_compressed_without_extension": lambda n: drain(scan(spark, unnamed, delimiter=",", codec="gzip", **text)),
        "route_events": lambda n: drain(route_events(uploads, rules(spark))),
        "route_events_100_rules": lambda n: drain(match_pairs(events, few)),
        "route_events_10000_rules": lambda n: drain(match_pairs(events, many)),
        "classify_path": lambda n: drain(classify_paths(asked, uploads)),
        "admit_events": lambda n: drain(run(visits, DAY, digest=F.col("event_type"))),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, work in benches(spark, sf_dir).items():
        times = []
        for number in range(ROUNDS + 1):
            started = time.perf_counter()
            work(number)
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(name, [round(t, 2) for t in times], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
