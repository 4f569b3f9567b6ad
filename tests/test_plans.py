"""Plans that must stay as they are for the work to scale."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from catalog.admission import DAY, narrow, run
from catalog.fixtures import dated_files, objects, rules, table
from dockline.operators.classify import classify_paths, path_index
from dockline.operators.ledger import latest_per_key
from dockline.operators.registry import fk_violations
from dockline.operators.routing import route_events, with_matches
from dockline.plans.load import LoadSpec, with_partition
from dockline.sinks.table import TableSpec, overwrite_table, read_table
from dockline.sources.scan import add_lineage, normalize_timestamps, source_files

from .conftest import SF_DIR


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events_table(spark, tmp_path_factory):
    target = TableSpec(path=str(tmp_path_factory.mktemp("t") / "events"), partition_column="ts")
    overwrite_table(normalize_timestamps(table(spark, SF_DIR, "events")), target)
    return target.path


def test_partition_range_prunes_folders(spark, events_table):
    text = plan(read_table(spark, events_table, between=("20240103", "20240104")).select("user_id"))
    assert re.search(r"PartitionFilters: \[.*part_id.*>= 20240103", text)
    # One column is read, and no folder is opened to find the schema.
    assert "ReadSchema: struct<user_id:bigint>" in text


def test_values_are_pushed_to_the_scan(spark, events_table):
    text = plan(read_table(spark, events_table).filter("user_id = 3").select("event_id"))
    assert "EqualTo(user_id,3)" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint>" in text


def test_a_load_is_one_scan_without_python(spark):
    root = dated_files(table(spark, SF_DIR, "events"), "ts", "yyyyMMdd", "parquet")
    load = LoadSpec(
        job="e", fmt="parquet", partition_regex=r"/(\d{8})/", partition_format="%Y%m%d", path_root="/daily/data",
        table=TableSpec(path="unused"),
    )
    source = add_lineage(spark.read.option("recursiveFileLookup", "true").parquet(root))
    text = plan(with_partition(source, load, source_files(spark, [root], True)))
    assert text.count("FileScan parquet") == 1
    assert "Python" not in text and "InPandas" not in text
    # The regex runs on the file list, below the broadcast.
    scan_side, file_side = text.split("BroadcastExchange", 1)
    assert "regexp_extract" not in scan_side and "gettimestamp" not in scan_side
    assert "gettimestamp" in file_side
    # Listing does not read the files.
    assert "content" not in re.search(r"FileScan binaryFile.*", text)[0].split("ReadSchema:")[1]


def test_routing_needs_no_shuffle(spark):
    text = plan(route_events(objects(spark, SF_DIR), rules(spark)))
    assert "Exchange" not in text and "Join" not in text
    # Every pattern stands in the plan once.
    assert text.count("RLIKE") == sum(1 for r in rules(spark).collect() if r.auto_trigger)


def test_matches_need_no_shuffle(spark):
    text = plan(with_matches(objects(spark, SF_DIR), rules(spark), ["o_orderkey"]))
    assert "Exchange" not in text and "Python" not in text


def test_path_index_combines_before_the_shuffle(spark):
    text = plan(path_index(objects(spark, SF_DIR)))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_classification_has_no_cross_join(spark):
    probes = objects(spark, SF_DIR).select("bucket", F.col("name").alias("path"))
    text = plan(classify_paths(probes, objects(spark, SF_DIR)))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_latest_record_is_ranked_before_the_shuffle(spark):
    ledger = table(spark, SF_DIR, "events").withColumnRenamed("ts", "created_at").withColumnRenamed("user_id", "task_key")
    assert re.search(r"WindowGroupLimit.*Partial", plan(latest_per_key(ledger)))


def test_anti_join(spark):
    text = plan(fk_violations(table(spark, SF_DIR, "orders"), table(spark, SF_DIR, "customer"), {"o_custkey": "c_custkey"}))
    assert "LeftAnti" in text and "NestedLoop" not in text


def test_admission_folds_in_arrow_batches(spark):
    text = plan(run(narrow(spark, SF_DIR), DAY, digest=F.col("event_type"), slices=4))
    assert "MapInArrow" in text
    # The order was fixed before the fold.
    assert "Exchange" not in text and "Sort" not in text
    assert "FlatMapGroups" not in text
