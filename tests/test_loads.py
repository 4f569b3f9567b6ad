"""Loads end to end: what they replace, what they leave, and how they fail."""

from __future__ import annotations

import bz2
import gzip
import os
import struct
from random import Random

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dockline.plans import load as load_module
from dockline.plans.load import LoadSpec, convert_format, run_load
from dockline.sinks.schema import SchemaConflict, merge_schemas
from dockline.sinks.table import (
    MissingTable,
    TableSpec,
    overwrite_partition,
    overwrite_partition_range,
    overwrite_table,
    read_table,
)
from dockline.sinks.versions import data_folder
from dockline.sources import manifest as manifests
from dockline.sources.manifest import expand_folders, expand_paths, expand_wildcard, object_manifest
from dockline.sources.scan import normalize_timestamps, scan


def write_days(root, days, rows=3):
    """Small CSV files ``<root>/<day>/part.csv`` with ``id,day`` rows."""
    for day in days:
        os.makedirs(f"{root}/{day}", exist_ok=True)
        with open(f"{root}/{day}/part.csv", "w") as file:
            file.writelines(f"{i},{day}\n" for i in range(rows))


def spec(target, **changes):
    table = dict(path=target, granularity=changes.pop("granularity", "DAY"), create=changes.pop("create", True))
    table.update(changes.pop("table", {}))
    fixed = dict(
        job="days", fmt="delimited", delimiter=",", schema="id:int,day:string", partition_regex=r"(\d{8})(?=/|$)",
        partition_format="%Y%m%d", path_root="/in", table=TableSpec(**table),
    )
    return LoadSpec(**{**fixed, **changes})


def contents(spark, target):
    rows = read_table(spark, target, with_part_id=True).groupBy("part_id").count().collect()
    return {r.part_id: r["count"] for r in rows}


def test_whole_table_then_fewer_days(spark, folder):
    source, target = f"{folder}/in", f"{folder}/table"
    write_days(source, ["20240101", "20240102"])
    run_load(spark, spec(target), source, "r1")
    assert contents(spark, target) == {"20240101": 3, "20240102": 3}
    run_load(spark, spec(target), f"{source}/20240102", "r2")
    assert contents(spark, target) == {"20240102": 3}


def test_partition_values_come_from_the_path(spark, folder):
    source, target = f"{folder}/in", f"{folder}/table"
    write_days(source, ["20240131", "20240229"])
    run_load(spark, spec(target), source, "r1")
    rows = read_table(spark, target).select("day", F.date_format("date", "yyyyMMdd").alias("d")).distinct().collect()
    assert sorted((r.day, r.d) for r in rows) == [("20240131", "20240131"), ("20240229", "20240229")]


@pytest.mark.parametrize("granularity, names", [("MONTH", {"202401": 6, "202402": 3}), ("YEAR", {"2024": 9})])
def test_values_finer_than_the_granularity(spark, folder, granularity, names):
    source, target = f"{folder}/in", f"{folder}/table"
    write_days(source, ["20240101", "20240115", "20240201"])
    ranged = spec(target, mode="partition_range", granularity=granularity)
    for run in ("r1", "r2"):
        run_load(spark, ranged, source, run)
    assert contents(spark, target) == names
    # One day stands for its whole partition.
    run_load(spark, ranged, f"{source}/20240115", "r3")
    assert contents(spark, target) == {**names, **({"202401": 3} if granularity == "MONTH" else {"2024": 3})}


def test_range_of_wildcard(spark, folder):
    source, target = f"{folder}/in", f"{folder}/table"
    write_days(source, ["20231231", "20240101", "20240102"])
    run_load(spark, spec(target, mode="partition_range"), f"{source}/2024*", "r1")
    assert contents(spark, target) == {"20240101": 3, "20240102": 3}
    with pytest.raises(FileNotFoundError):
        run_load(spark, spec(target, mode="partition_range"), f"{source}/2025*", "r2")


def test_one_partition(spark, folder):
    source, target = f"{folder}/in", f"{folder}/table"
    write_days(source, ["20240101", "20240102"])
    single = spec(target, mode="partition")
    for day in ("20240101", "20240102", "20240102"):
        run_load(spark, single, f"{source}/{day}", "r1")
    assert contents(spark, target) == {"20240101": 3, "20240102": 3}
    with pytest.raises(ValueError, match="one input path"):
        run_load(spark, single, [f"{source}/20240101", f"{source}/20240102"], "r2")


@pytest.mark.parametrize("limit", [200_000, 0])
@pytest.mark.parametrize("bad", ["nodate", "20241399"])
def test_a_bad_path_fails_the_load_and_keeps_the_table(spark, folder, bad, limit, monkeypatch):
    monkeypatch.setattr(load_module, "BROADCAST_FILES", limit)
    source, target = f"{folder}/in", f"{folder}/table"
    write_days(source, ["20240101"])
    run_load(spark, spec(target), source, "r1")
    write_days(source, ["20240102", bad])
    with pytest.raises(PySparkException, match="no partition value"):
        run_load(spark, spec(target, audit_path=f"{folder}/audit"), source, "r2")
    assert contents(spark, target) == {"20240101": 3}
    audit = spark.read.json(f"{folder}/audit").head()
    assert (audit.status, audit.run_uuid) == ("failed", "r2")
    assert "no partition value" in audit.error


@pytest.mark.parametrize("limit", [200_000, 0])
def test_quarantine(spark, folder, limit, monkeypatch):
    monkeypatch.setattr(load_module, "BROADCAST_FILES", limit)
    source, target, aside = f"{folder}/in", f"{folder}/table", f"{folder}/aside"
    write_days(source, ["20240101", "nodate", "20241399"])
    careful = spec(target, on_error="quarantine", quarantine_path=aside)
    for _ in range(2):
        audit = run_load(spark, careful, source, "r1").head()
    assert (audit.row_count, audit.rejected_count, audit.partitions) == (3, 6, ["20240101"])
    rejected = spark.read.parquet(aside)
    assert {(r.reasons[0], r["count"]) for r in rejected.groupBy("reasons").count().collect()} == {
        ("no partition in path", 3), ("malformed partition value", 3),
    }
    assert rejected.filter("path LIKE '%nodate%'").orderBy("raw").head().raw == '{"id":0,"day":"nodate"}'


def test_one_partition_loads_nothing_that_was_set_aside(spark, folder):
    source, aside = f"{folder}/in", f"{folder}/aside"
    write_days(source, ["20240101"])
    # The folder names a partition, the file below it does not.
    careful = spec(f"{folder}/table", mode="partition", partition_regex=r"/(\d{8})$", on_error="quarantine", quarantine_path=aside)
    audit = run_load(spark, careful, f"{source}/20240101", "r1").head()
    assert (audit.row_count, audit.rejected_count) == (0, 3)
    assert spark.read.parquet(aside).count() == 3 and contents(spark, f"{folder}/table") == {}


def test_quarantine_keeps_the_columns_of_the_path(spark, folder):
    source, aside = f"{folder}/in", f"{folder}/aside"
    write_days(source, ["region=eu/day=20240101", "region=eu/day=20240199"])
    careful = spec(
        f"{folder}/table", recursive=False, partition_regex=r"day=(\d{8})", on_error="quarantine", quarantine_path=aside,
        audit_path=f"{folder}/audit",
    )
    for _ in range(2):
        run_load(spark, careful, source, "r1")
    assert spark.read.parquet(aside).orderBy("raw").head().raw == '{"id":0,"region":"eu","day":"20240199"}'
    assert spark.read.json(f"{folder}/audit").count() == 1


def test_paths_with_escapes(spark, folder):
    source, target = f"{folder}/in", f"{folder}/table"
    write_days(f"{source}/a b%+c", ["20240101"])
    run_load(spark, spec(target, partition_regex=r"a b%\+c/(\d{8})/"), source, "r1")
    assert contents(spark, target) == {"20240101": 3}


def test_key_value_root_keeps_the_path_value(spark, folder):
    source, target = f"{folder}/in", f"{folder}/table"
    write_days(source, ["date=20240101", "date=20240102"])
    run_load(spark, spec(target, recursive=False, partition_regex=r"date=(\d{8})"), source, "r1")
    table = read_table(spark, target)
    assert table.schema["date"].dataType.simpleString() == "timestamp"
    assert contents(spark, target) == {"20240101": 3, "20240102": 3}


def test_hours(spark, folder):
    source, target = f"{folder}/in", f"{folder}/table"
    write_days(source, ["2024010107", "2024010123"])
    hourly = spec(target, granularity="HOUR", partition_regex=r"/(\d{10})/", partition_format="%Y%m%d%H")
    run_load(spark, hourly, source, "r1")
    assert contents(spark, target) == {"2024010107": 3, "2024010123": 3}
    with pytest.raises(ValueError, match="HOUR"):
        TableSpec(path=target, granularity="HOUR", column_type="date")


def test_date_columns(spark, folder):
    source, target = f"{folder}/in", f"{folder}/table"
    write_days(source, ["20240101"])
    run_load(spark, spec(target, table={"column_type": "date"}), source, "r1")
    assert read_table(spark, target).schema["date"].dataType.simpleString() == "date"


def test_create_only_where_allowed(spark, folder):
    source, target = f"{folder}/in", f"{folder}/table"
    write_days(source, ["20240101"])
    with pytest.raises(MissingTable):
        run_load(spark, spec(target, create=False), source, "r1")
    run_load(spark, spec(target), source, "r2")
    run_load(spark, spec(target, create=False), source, "r3")
    assert contents(spark, target) == {"20240101": 3}


def test_input_inside_the_target_is_refused(spark, folder):
    write_days(f"{folder}/table/in", ["20240101"])
    with pytest.raises(ValueError, match="overlap"):
        run_load(spark, spec(f"{folder}/table"), f"{folder}/table/in", "r1")
    with pytest.raises(ValueError, match="overlap"):
        convert_format(spark, f"{folder}/table/in", "json", f"{folder}/table", "json")


def test_dry_run_writes_nothing(spark, folder):
    source, target = f"{folder}/in", f"{folder}/table"
    write_days(source, ["20240101"])
    row = run_load(spark, spec(target), source, "r1", dry_run=True).head()
    assert (row.status, row.columns, row.row_count) == ("dry_run", ["id", "day"], None)
    assert not os.path.exists(target)


def test_staging_and_transform(spark, folder):
    source, target = f"{folder}/in", f"{folder}/table"
    write_days(source, ["20240101", "20240102"])
    keep_even = lambda df, params: df.filter(F.col("id") % params["n"] == 0)
    staged = spec(target, staging_path=f"{folder}/staging", transform=keep_even, params={"n": 2})
    run_load(spark, staged, source, "r1")
    assert contents(spark, target) == {"20240101": 2, "20240102": 2}


def frame(spark, sql):
    return spark.sql(sql)


def test_new_and_missing_columns(spark, folder):
    table = TableSpec(path=f"{folder}/t", partition_column="d")
    overwrite_partition_range(frame(spark, "SELECT 1 AS a, 'x' AS b, TIMESTAMP'2024-01-01' AS d"), table)
    overwrite_partition_range(frame(spark, "SELECT 2 AS a, 1.5D AS c, TIMESTAMP'2024-01-02' AS d"), table)
    rows = read_table(spark, table.path).orderBy("a").select("a", "b", "c").collect()
    assert [tuple(r) for r in rows] == [(1, "x", None), (2, None, 1.5)]


def test_nested_and_wide_types_pass_through(spark, folder):
    table = TableSpec(path=f"{folder}/t", partition_column="d")
    df = frame(
        spark,
        "SELECT CAST(1.25 AS DECIMAL(30,2)) AS n, map('k', array(1)) AS m, named_struct('x', 1L) AS s, TIMESTAMP'2024-01-01' AS d",
    )
    for _ in range(2):
        overwrite_table(df, table)
    assert [tuple(r) for r in read_table(spark, table.path).collect()] == [tuple(r) for r in df.collect()]
    clustered = TableSpec(path=f"{folder}/t", partition_column="d", cluster_by=("n",))
    overwrite_table(df, clustered)
    assert read_table(spark, table.path).count() == 1


def test_a_changed_type_is_found_before_writing(spark, folder):
    table = TableSpec(path=f"{folder}/t", partition_column="d")
    overwrite_table(frame(spark, "SELECT 1 AS a, TIMESTAMP'2024-01-01' AS d"), table)
    with pytest.raises(SchemaConflict, match="column a"):
        overwrite_table(frame(spark, "SELECT 'one' AS a, TIMESTAMP'2024-01-02' AS d"), table)
    assert [r.a for r in read_table(spark, table.path).collect()] == [1]


def test_schema_merge_ignores_case_and_nullability(spark):
    one = frame(spark, "SELECT 1 AS a, array(1) AS b").schema
    two = frame(spark, "SELECT CAST(NULL AS INT) AS A, array(CAST(NULL AS INT)) AS b, 'x' AS c").schema
    assert merge_schemas(one, two).fieldNames() == ["a", "b", "c"]


def test_empty_loads(spark, folder):
    table = TableSpec(path=f"{folder}/t", partition_column="d")
    df = frame(spark, "SELECT id, TIMESTAMP'2024-01-01' AS d FROM range(5)")
    overwrite_table(df, table)
    # Nothing to replace.
    overwrite_partition_range(df.filter("id < 0"), table)
    assert contents(spark, table.path) == {"20240101": 5}
    overwrite_partition(df.filter("id < 0"), table, "2024-01-01")
    assert contents(spark, table.path) == {}
    overwrite_table(df, table)
    overwrite_table(df.filter("id < 0"), table)
    empty = read_table(spark, table.path)
    assert (empty.columns, empty.count()) == (["id", "d"], 0)


def test_reserved_column(spark, folder):
    df = frame(spark, "SELECT 1 AS part_id, TIMESTAMP'2024-01-01' AS d")
    with pytest.raises(ValueError, match="part_id"):
        overwrite_table(df, TableSpec(path=f"{folder}/t", partition_column="d"))


def test_hot_partition_is_split(spark, folder):
    """One partition with nearly all rows is written by several tasks."""
    small = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(small)
    spark.conf.set(small, "200k")
    try:
        df = spark.range(0, 400_000, numPartitions=8).select(
            "id", F.sha2(F.col("id").cast("string"), 256).alias("text"),
            F.when(F.col("id") % 100 == 0, F.lit("2024-01-02")).otherwise(F.lit("2024-01-01")).cast("timestamp").alias("d"),
        )
        overwrite_table(df, TableSpec(path=f"{folder}/t", partition_column="d"))
    finally:
        spark.conf.set(small, before)
    stored = f"{data_folder(spark, f'{folder}/t')}/part_id=20240101"
    files = [f for f in os.listdir(stored) if f.endswith(".parquet")]
    assert len(files) > 1
    assert read_table(spark, f"{folder}/t").count() == 400_000


def test_wildcards_over_a_manifest(spark, folder):
    names = ["a/2024/x", "a/2025/x", "a/2025/y", "a/20256", "a/_2025/x", "a/2025z/", "b/1/c/f", "b/2/c/f", "b/2/d/f"]
    manifest = spark.createDataFrame([("b", n) for n in names], "bucket string, name string")
    matched = lambda pattern: [r.path for r in expand_wildcard(manifest, pattern).collect()]
    assert matched("a/2025*") == ["a/2025", "a/2025z"]
    assert matched("a/202?/") == ["a/2024", "a/2025"]
    assert matched("a/*") == ["a/2024", "a/2025", "a/2025z"]
    assert matched("b/*/c") == ["b/1/c", "b/2/c"]
    assert matched("*") == ["a", "b"]
    assert expand_paths(manifest, "a/2024", "gs://b/") == ["gs://b/a/2024"]
    with pytest.raises(FileNotFoundError):
        expand_paths(manifest, "z/*", "gs://b")


def test_wildcards_over_a_file_system(spark, folder, monkeypatch):
    listed = []

    class Watched(manifests.Folder):
        def children(self):
            listed.append(self.qualified().split(folder)[-1])
            return super().children()

    monkeypatch.setattr(manifests, "Folder", Watched)
    root = f"{folder}/in"
    write_days(root, ["2024/01", "2025/01", "2025/02", "_2025/01", "20256/02/deep", "2025 x/02"])
    os.makedirs(f"{root}/2025e/02")
    open(f"{root}/2025f", "w").close()
    assert expand_folders(spark, f"{root}/2025*/02") == [f"{root}/2025 x/02", f"{root}/2025/02", f"{root}/20256/02"]
    assert listed == ["/in"]
    assert expand_folders(spark, f"{root}/202?/0[!2]/") == [f"{root}/2024/01", f"{root}/2025/01"]
    assert sorted(listed[1:]) == ["/in", "/in/2024", "/in/2025"]
    assert expand_folders(spark, f"{root}/*5") == [f"{root}/2025"]
    assert expand_folders(spark, f"{root}/2024") == [f"{root}/2024"]
    with pytest.raises(FileNotFoundError):
        expand_folders(spark, f"{root}/2025*/03")
    with pytest.raises(FileNotFoundError):
        expand_folders(spark, f"{folder}/none/*")


def test_manifest_of_a_folder(spark, folder):
    write_days(f"{folder}/in dir", ["20240101"])
    row = object_manifest(spark, f"{folder}/in dir", "bucket").head()
    assert (row.bucket, row.name, row.size) == ("bucket", "20240101/part.csv", 33)


LINES = "id,name\n1,one\n\n2,\"t,wo\"\n3,drei\r\n"


@pytest.mark.parametrize("codec, pack", [("gzip", gzip.compress), ("bzip2", bz2.compress)])
def test_codec_without_extension(spark, folder, codec, pack):
    os.makedirs(f"{folder}/in/20240101")
    head, tail = LINES.encode()[:20], LINES.encode()[20:]
    with open(f"{folder}/in/20240101/part", "wb") as file:
        # Two members, the line in the middle is cut between them.
        file.write(pack(head) + pack(tail))
    read = lambda **more: scan(spark, f"{folder}/in", "delimited", delimiter=",", has_header=True, codec=codec, recursive=True, **more)
    rows = [(1, "one"), (2, "t,wo"), (3, "drei")]
    assert sorted(tuple(r) for r in read(schema="id:int,name:string").collect()) == rows
    inferred = read()
    assert [f.dataType.simpleString() for f in inferred.schema] == ["int", "string"]
    assert sorted(tuple(r) for r in inferred.collect()) == rows
    loaded = spec(f"{folder}/table", codec=codec, has_header=True, schema="id:int,name:string")
    run_load(spark, loaded, f"{folder}/in", "r1")
    assert contents(spark, f"{folder}/table") == {"20240101": 3}


def test_large_compressed_file_comes_in_pieces(spark, folder):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/part", "wb") as file:
        file.write(gzip.compress(b"".join(b"%d,%s\n" % (i, b"x" * 60) for i in range(200_000))))
    df = scan(spark, f"{folder}/in", "delimited", delimiter=",", schema="id:int,name:string", codec="gzip")
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("s"), F.max(F.length("name")).alias("l")).head()
    assert tuple(row) == (200_000, sum(range(200_000)), 60)


def packed(codec, data):
    if codec == "snappy":
        raw = pa.Codec("snappy").compress(data, asbytes=True)
        return struct.pack(">II", len(data), len(raw)) + raw
    return {"gzip": gzip.compress, "bzip2": bz2.compress}[codec](data)


@pytest.fixture()
def small_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("codec", ["gzip", "bzip2", "snappy"])
def test_compressed_bytes_are_read_by_many_tasks(spark, folder, small_splits, codec):
    """Files of many splits come out whole and in order, whatever bytes they hold."""
    os.makedirs(f"{folder}/in")
    random = Random(7)
    expected = []
    for name in ("one", "two", "three"):
        rows = [f"{name}{i},{random.getrandbits(400):x}" for i in range(4_000)]
        expected += rows
        with open(f"{folder}/in/{name}", "wb") as file:
            file.write(packed(codec, "\n".join(rows[:1500]).encode() + b"\n") + packed(codec, "\n".join(rows[1500:]).encode()))
    df = scan(spark, f"{folder}/in", "delimited", delimiter=",", schema="id:string,hex:string", codec=codec)
    assert sorted(f"{r.id},{r.hex}" for r in df.collect()) == sorted(expected)
    plan = df._jdf.queryExecution().toString()
    assert "binaryFile" not in plan and "Format: Text" in plan
    assert len(df.inputFiles()) == 3


@pytest.mark.parametrize("last", [b"\n", b"\r"])
def test_compressed_files_may_end_in_a_line_feed(spark, folder, last):
    os.makedirs(f"{folder}/in")
    packs = (bz2.compress(b"a,%d\n" % i) for i in range(5_000))
    with open(f"{folder}/in/part", "wb") as file:
        file.write(next(data for data in packs if data.endswith(last)))
    df = scan(spark, f"{folder}/in", "delimited", delimiter=",", schema="a:string,n:int", codec="bzip2")
    assert [r.a for r in df.collect()] == ["a"]


def test_zeros_behind_gzip_members(spark, folder):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/part", "wb") as file:
        file.write(gzip.compress(b"a,1\n") + gzip.compress(b"b,2\n") + b"\0" * 600)
    df = scan(spark, f"{folder}/in", "delimited", delimiter=",", schema="a:string,n:int", codec="gzip")
    assert [r.a for r in df.collect()] == ["a", "b"]


def test_empty_compressed_files(spark, folder):
    os.makedirs(f"{folder}/in")
    for name, data in [("none", b""), ("nothing", gzip.compress(b"")), ("blank", gzip.compress(b"\n\r\n"))]:
        with open(f"{folder}/in/{name}", "wb") as file:
            file.write(data)
    for header in (True, False):
        df = scan(spark, f"{folder}/in", "delimited", delimiter=",", has_header=header, schema="a:int", codec="gzip")
        assert df.collect() == []


def test_header_of_each_compressed_file(spark, folder):
    """Blank lines before a header, columns in other orders, columns that a file lacks, types that differ."""
    os.makedirs(f"{folder}/in/below")
    files = {
        "a": "\n  \nid,name,n\n1,one,7\n2,,8\n",
        "b": "name,id,n\nthree,3,x\n",
        "c": "id,extra\n4,2024-01-01\n",
        "d": "only,header\n",
        "below/a": "id,name,n\n5,five,9\n",
    }
    for name, text in files.items():
        with open(f"{folder}/in/{name}", "wb") as file:
            file.write(gzip.compress(text.encode()))
    paths = [f"{folder}/in", f"{folder}/in/below/", f"{folder}/in"]
    df = scan(spark, paths, "delimited", delimiter=",", has_header=True, codec="gzip", recursive=True)
    assert dict(df.dtypes) == {
        "id": "int", "name": "string", "n": "string", "extra": "date", "only": "string", "header": "string"
    }
    assert sorted((r.id, r.name, r.n, str(r.extra), r.only) for r in df.collect()) == [
        (1, "one", "7", "None", None),
        (2, None, "8", "None", None),
        (3, "three", "x", "None", None),
        (4, None, None, "2024-01-01", None),
        (5, "five", "9", "None", None),
    ]
    plain = scan(spark, f"{folder}/in/below", "delimited", delimiter=",", has_header=True, codec="gzip")
    assert plain.dtypes == [("id", "int"), ("name", "string"), ("n", "int")]


def test_truncated_data_is_an_error(spark, folder):
    os.makedirs(f"{folder}/in")
    with open(f"{folder}/in/part", "wb") as file:
        file.write(gzip.compress(LINES.encode() * 100)[:-12])
    with pytest.raises(PySparkException, match="ends early"):
        scan(spark, f"{folder}/in", "delimited", delimiter=",", schema="id:int,name:string", codec="gzip").collect()


@pytest.mark.parametrize(
    "options",
    [dict(fmt="xml"), dict(fmt="delimited"), dict(fmt="json", codec="lzo"), dict(fmt="delimited", delimiter="ab")],
)
def test_bad_scan_options(spark, folder, options):
    with pytest.raises(ValueError):
        scan(spark, folder, **options)


def test_no_paths(spark):
    with pytest.raises(ValueError, match="no paths"):
        scan(spark, [], "json")


def test_avro_without_its_module(spark, folder):
    try:
        spark.read.format("avro").schema("a int").load([])
    except PySparkException:
        with pytest.raises(RuntimeError, match="spark-avro"):
            scan(spark, folder, "avro")
    else:
        pytest.skip("the Avro module is there")


def test_naive_timestamps_become_instants(spark):
    df = normalize_timestamps(spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 05:00:00' AS t, 1 AS n"))
    assert df.select(F.col("t").cast("string"), "n").head()[0] == "2024-01-01 05:00:00"
    assert df.schema["t"].dataType.simpleString() == "timestamp"


def dated(spark, rows):
    return spark.createDataFrame(rows, "a bigint, date string").withColumn("date", F.col("date").cast("timestamp"))


OLD, NEW = [(1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-03")], [(7, "2024-01-02"), (8, "2024-01-05")]


def stored_in(path):
    """Version folders, and partitions that are in none."""
    return sorted(x for f in (path, f"{path}/_versions") for x in os.listdir(f) if not x.startswith((".", "_")))


@pytest.mark.parametrize("first", [overwrite_table, overwrite_partition_range])
@pytest.mark.parametrize("step, after", [("publish", "old"), ("sweep", "new")])
def test_full_overwrite_is_one_step(spark, folder, monkeypatch, first, step, after):
    """A run that ends anywhere shows the old table or the new one, and the next run clears up."""
    from dockline.sinks import table as sink

    table = TableSpec(f"{folder}/t")
    first(dated(spark, OLD), table)
    rows = lambda: sorted(r.a for r in read_table(spark, table.path).collect())

    def ended(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patched, pytest.raises(KeyboardInterrupt):
        patched.setattr(sink, step, ended)
        overwrite_table(dated(spark, NEW).withColumn("more", F.lit("x")), table)
    assert rows() == ([1, 2, 3] if after == "old" else [7, 8])
    assert ("more" in read_table(spark, table.path).columns) == (after == "new")
    overwrite_table(dated(spark, NEW), table)
    assert rows() == [7, 8] and len(stored_in(table.path)) == 1
    assert len([x for x in os.listdir(f"{table.path}/_current") if not x.startswith(".")]) == 1


def test_partitions_are_replaced_in_the_current_version(spark, folder):
    table = TableSpec(f"{folder}/t")
    overwrite_partition_range(dated(spark, OLD), table)
    overwrite_table(dated(spark, NEW), table)
    overwrite_partition_range(dated(spark, [(9, "2024-01-05"), (10, "2024-01-06")]).withColumn("b", F.lit(1)), table)
    assert contents(spark, table.path) == {"20240102": 1, "20240105": 1, "20240106": 1}
    overwrite_partition(dated(spark, []), table, "2024-01-02")
    assert {tuple(r) for r in read_table(spark, table.path).select("a", "b").collect()} == {(9, 1), (10, 1)}
    overwrite_table(dated(spark, []), table)
    empty = read_table(spark, table.path)
    assert empty.count() == 0 and empty.columns == ["a", "date", "b"] and len(stored_in(table.path)) == 1


def test_a_lost_version_is_not_published(spark, folder):
    from dockline.sinks.versions import publish

    overwrite_table(dated(spark, OLD), TableSpec(f"{folder}/t"))
    with pytest.raises(OSError, match="is gone"):
        publish(spark, f"{folder}/t", "version-00000002-x")
    assert read_table(spark, f"{folder}/t").count() == 3
