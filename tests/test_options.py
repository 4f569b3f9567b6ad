from __future__ import annotations

import fnmatch
import random
import re

import pytest
from pyspark.sql import functions as F

from dockline.options import glob_regex, java_regex, parse_schema, parse_separator, spark_datetime_pattern


@pytest.mark.parametrize(
    "text, char", [(",", ","), ("u+0001", "\x01"), ("U+007C", "|"), ("0x01", "\x01"), ("0o11", "\t"), ("0b1", "\x01"), ("\t", "\t")]
)
def test_separators(text, char):
    assert parse_separator(text) == char


@pytest.mark.parametrize("text", ["", "||", "u+", "0xzz"])
def test_bad_separators(text):
    with pytest.raises(ValueError):
        parse_separator(text)


def test_schema_text():
    schema = parse_schema("a:int, b: string,c:Integer, d:float,e:double,f:boolean,g:date,h:timestamp")
    assert schema.simpleString() == (
        "struct<a:int,b:string,c:int,d:float,e:double,f:boolean,g:date,h:timestamp>"
    )
    assert all(field.nullable for field in schema.fields)


@pytest.mark.parametrize("text", ["a", "a:", ":int", "a:long", "a:decimal(3,1)", "a:int,,b:int"])
def test_bad_schema_text(text):
    with pytest.raises(ValueError):
        parse_schema(text)


@pytest.mark.parametrize(
    "python, spark_pattern",
    [
        ("%Y%m%d", "yyyyMMdd"),
        ("%Y-%m-%dT%H:%M:%S.%f", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        ("%Y%j", "yyyyDDD"),
        ("%d %b %Y", "dd MMM yyyy"),
        ("year=%Y/it's %m", "'year='yyyy'/it''s 'MM"),
        ("100%%%Y", "'100%'yyyy"),
    ],
)
def test_datetime_patterns(python, spark_pattern):
    assert spark_datetime_pattern(python) == spark_pattern


@pytest.mark.parametrize("python", ["%m%d", "%Y%q", "%Y%"])
def test_bad_datetime_patterns(python):
    with pytest.raises(ValueError):
        spark_datetime_pattern(python)


def test_datetime_pattern_parses(spark):
    from datetime import datetime

    moment = datetime(2031, 4, 5, 6, 7, 8)
    formats = ["%Y%m%d%H%M%S", "year=%Y/it's %m/%dT%H.%M.%S", "%d-%b-%Y %H:%M:%S", "%Y %j %H %M %S"]
    row = spark.range(1).select(
        *(
            F.to_timestamp(F.lit(moment.strftime(f)), spark_datetime_pattern(f)).cast("string").alias(str(i))
            for i, f in enumerate(formats)
        )
    )
    assert list(row.head()) == ["2031-04-05 06:07:08"] * len(formats)


def test_regex_dialect():
    assert java_regex(r"(?P<day>\d{8})/(?P=day)") == r"(?<day>\d{8})/\k<day>"
    with pytest.raises(ValueError):
        java_regex(r"\d+", need_group=True)
    with pytest.raises(re.error):
        java_regex("(")


def test_glob_agrees_with_fnmatch(spark):
    random.seed(7)
    letters = "ab1/.[]!-^ $+\\"
    names = ["".join(random.choices(letters, k=random.randint(0, 6))) for _ in range(300)]
    patterns = ["".join(random.choices(letters + "**??", k=random.randint(1, 5))) for _ in range(60)]
    patterns += ["[ab]*", "[!a]*", "[a-b1]?", "[]a]*", "[!]]*", "[", "a[", "*[.]*", "[^a]"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    checks = df.select("n", *(F.col("n").rlike(glob_regex(p)).alias(str(i)) for i, p in enumerate(patterns)))
    for row in checks.collect():
        for i, pattern in enumerate(patterns):
            assert row[str(i)] == fnmatch.fnmatchcase(row.n, pattern), (row.n, pattern)


def test_glob_within_segments(spark):
    df = spark.createDataFrame([("a/b",), ("ab",)], "n string")
    assert [r.n for r in df.filter(F.col("n").rlike(glob_regex("a*", cross_slash=False))).collect()] == ["ab"]
