from __future__ import annotations

import hashlib
import posixpath
import random
from datetime import timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from dockline.functions import durations, hashing, paths, text


def values(spark, items, build, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], f"i int, v {kind}")
    return [r.x for r in df.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


def random_paths(n=200):
    random.seed(3)
    return ["".join(random.choices("ab/.", k=random.randint(0, 8))) for _ in range(n)]


def test_path_helpers_agree_with_the_standard_library(spark):
    names = random_paths()
    folder = lambda p: p if p.endswith("/") else posixpath.dirname(p).rstrip("/") + "/"
    assert values(spark, names, paths.strip_filename) == [folder(p) for p in names]
    assert values(spark, names, paths.trim_slashes) == [p.strip("/") for p in names]
    assert values(spark, names, paths.last_segment) == [p.split("/")[-1] for p in names]
    keys = values(spark, names, lambda v: paths.task_key_folder(F.lit("b"), v))
    assert keys == ["b/" + p.rsplit("/", 1)[0] for p in names]


def test_ancestors(spark):
    found = values(spark, ["a/b/c.csv", "a/b/", "x", ""], paths.ancestor_folders)
    assert found == [["a", "a/b"], ["a", "a/b"], [], []]


def test_decoded_paths(spark):
    found = values(spark, ["file:/a%20b/c+d", "file:/plain", "a%2Fb%25"], paths.decoded_file_path)
    assert found == ["file:/a b/c+d", "file:/plain", "a/b%"]


def test_uris(spark):
    uris = ["gs://b/a/c.csv", "s3a://b", "gs://b/"]
    assert values(spark, uris, paths.uri_bucket) == ["b", "b", "b"]
    assert values(spark, uris, paths.uri_path) == ["a/c.csv", "", ""]


@pytest.mark.parametrize(
    "written, micros",
    [
        ("PT30S", 30_000_000),
        ("PT30M", 1_800_000_000),
        ("P1D", 86_400_000_000),
        ("P1DT2H3M4.5S", 93_784_500_000),
        ("P2W", 1_209_600_000_000),
        ("-PT5S", -5_000_000),
        ("PT0S", 0),
        ("P1M", None),
        ("P1Y", None),
        ("PT", None),
        ("P", None),
        ("30", None),
    ],
)
def test_iso_durations(spark, written, micros):
    assert values(spark, [written], durations.iso_duration_micros) == [micros]


def test_iso_duration_round_trip(spark):
    random.seed(5)
    sizes = [random.randint(0, 10**13) for _ in range(200)] + [0, 1, 86_400_000_000]
    back = values(spark, sizes, lambda v: durations.iso_duration_micros(durations.format_iso_duration(v)), "bigint")
    assert back == sizes
    as_interval = values(spark, sizes, lambda v: durations.micros_to_interval(v), "bigint")
    assert as_interval == [timedelta(microseconds=s) for s in sizes]


def test_render_args(spark):
    context = {"a": F.lit("$1\\{{ b }}"), "b": F.lit("B")}
    args = F.array(F.lit("x={{a}};{{ b }}"), F.lit("{{ b"), F.lit("plain"))
    row = spark.range(1).select(text.render_args(args, context).alias("x")).head()
    assert row.x == ["x=$1\\{{ b }};B", "{{ b", "plain"]
    with pytest.raises(PySparkException, match="unknown template variable: bucket"):
        spark.range(1).select(text.render_args(F.array(F.lit("{{ bucket }}")), context)).collect()


def test_set_arg(spark):
    row = spark.range(1).select(text.set_arg(F.array(F.lit("--run_uuid=1"), F.lit("-x")), F.lit("2")).alias("x")).head()
    assert row.x == ["-x", "--run_uuid=2"]


def test_content_hash_parts(spark):
    def digest(mode, **given):
        names = ("bucket", "prefix", "file_name", "generation", "md5_hash", "crc32c", "manual_hint")
        columns = [F.lit(given.get(n)).cast("string") for n in names]
        return spark.range(1).select(hashing.content_hash(F.lit(mode), *columns).alias("x")).head().x

    def expected(*parts):
        return hashlib.sha256("::".join(parts).encode()).hexdigest()

    base = dict(bucket="b", prefix="p/")
    assert digest("marker", **base) == expected("b", "p/", "_UNKNOWN_MARKER", "")
    assert digest("marker", **base, file_name="f", generation="7", manual_hint="h") == expected("b", "p/", "f", "7", "h")
    assert digest("file", **base, file_name="") == expected("b", "p/", "_UNKNOWN_FILE", "_NO_HASH")
    assert digest("file", **base, file_name="f", md5_hash="", crc32c="c", generation="7") == expected("b", "p/", "f", "c")
    assert digest("folder", **base, file_name="f", generation="7") == expected("b", "p/")
    assert digest("folder", **base, manual_hint="h") == expected("b", "p/", "h")
    with pytest.raises(PySparkException, match="unknown mode"):
        digest("other", **base)


def test_uid_needs_a_generation(spark):
    row = spark.range(1).select(
        paths.event_uid(F.lit("b"), F.lit("n"), F.lit(None).cast("string")).alias("none"),
        paths.event_uid(F.lit("b"), F.lit("n"), F.lit("3")).alias("some"),
    ).head()
    assert (row.none, row.some) == (None, "b/n/3")


def test_audit_json_leaves_out_nulls(spark):
    row = spark.range(1).select(text.audit_json(a=F.lit("x"), b=F.lit(None).cast("string"), c=F.lit(1)).alias("x")).head()
    assert row.x == '{"a":"x","c":1}'
