"""Matching by each physical form, against a plain loop."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from dockline.operators import classify, routing
from dockline.operators.classify import classify_paths, resolve_input_path
from dockline.operators.factors import grams, literal_factors, rarest_grams
from dockline.operators.routing import (
    _keyed_rules,
    _lookup_keys,
    analyze_path,
    match_pairs,
    nameless_events,
    route_events,
    rule_anchor,
    with_matches,
)

EVENTS = "id bigint, bucket string, name string"
RULES = "ordinal bigint, name string, source_bucket string, source_prefix string, mode string, auto_trigger boolean"

PATTERNS = [
    r"^a/b/\d+\.csv$", r"^a/b/", r"b/", r"^a/|^c/", r"^a/?b", r"^(a|b)/", r"^a/(?P<x>\d)(?P=x)", r"^c d/e-f/", r"$", r"^$",
    r"^a/b/+x", r"(?i)^A/", r"^a\/b", r"^a/b*/", r"^a/{1,2}b/",
    # Without a literal folder at the start.
    r"/c d/\w+\.csv$", r"e-f/1\.csv", r"(c d/)+e-f", r"(?:x/)?c d/e", r"[ab]/c d/", r"(1\.csv|22)$", r"(?P<x>.)/c d/(?P=x)",
]


def make(spark, n=400):
    random.seed(17)
    parts = ["a", "b", "c d", "e-f", "A", "x"]
    events = []
    for i in range(n):
        depth = random.randint(0, 3)
        name = "/".join(random.choices(parts, k=depth)) + ("/" if depth else "") + random.choice(["", "1.csv", "22", "x"])
        events.append((i, f"b{random.randrange(3)}", random.choice([name, name, name, None])))
    rules = [
        (i, f"r{i}", f"b{random.randrange(3)}", p, random.choice(["file", "marker", "folder"]), random.choice([True, False, None]))
        for i, p in enumerate(PATTERNS * 2)
    ]
    return events, rules


def expected_pairs(events, rules):
    return {
        (e[0], r[1])
        for e in events
        for r in rules
        if r[2] == e[1] and (r[4] == "folder" or e[2]) and re.search(r[3], e[2] or "")
    }


@pytest.fixture(params=["inline", "broadcast", "shuffled"])
def form(request, monkeypatch):
    if request.param != "inline":
        monkeypatch.setattr(routing, "INLINE_RULES", 0)
    if request.param == "shuffled":
        monkeypatch.setattr(routing, "BROADCAST_RULES", 1)
    return request.param


def test_pairs(spark, form):
    events, rules = make(spark)
    pairs = match_pairs(spark.createDataFrame(events, EVENTS), spark.createDataFrame(rules, RULES))
    found = [(r.id, r.rule.name) for r in pairs.collect()]
    assert len(found) == len(set(found))
    assert set(found) == expected_pairs(events, rules)


def test_matches_are_in_registry_order(spark, form):
    events, rules = make(spark, 150)
    df = with_matches(spark.createDataFrame(events, EVENTS), spark.createDataFrame(rules, RULES), ["id"])
    pairs = expected_pairs(events, rules)
    for row in df.collect():
        assert [m.name for m in row.matches] == [r[1] for r in rules if (row.id, r[1]) in pairs]


def test_repeated_and_null_keys(spark, form):
    events = [(1, "b0", "a/x"), (1, "b0", "z"), (None, "b0", "a/x"), (2, None, "a/x"), (3, "b0", None)]
    rules = [(0, "r", "b0", "^a/", "file", True), (1, "s", "b0", r"^\p{L}/", None, True)]
    df = with_matches(spark.createDataFrame(events, EVENTS), spark.createDataFrame(rules, RULES), ["id"])
    found = sorted((str(r.id), str(r.bucket), str(r.name), len(r.matches)) for r in df.collect())
    assert found == [
        ("1", "b0", "a/x", 2), ("1", "b0", "z", 0), ("2", "None", "a/x", 0), ("3", "b0", "None", 0), ("None", "b0", "a/x", 2)
    ]


def test_folder_rules_need_a_folder(spark, form):
    events = spark.createDataFrame([(1, "b", "a/b"), (2, "b", "both"), (3, "b", "nope"), (4, "b", "a/*")], EVENTS)
    rules = spark.createDataFrame([(0, "f", "b", ".", "folder", True), (1, "o", "b", "^both", None, False)], RULES)
    manifest = spark.createDataFrame(OBJECTS, "bucket string, name string")
    jobs = {r.id: (r.job, r.error) for r in routing.resolve_single_job(events, rules, ["id"], manifest).collect()}
    assert jobs == {1: ("f", None), 2: ("o", None), 3: (None, "not found"), 4: ("f", None)}
    status = {r.id: r.status for r in routing.event_disposition(events, rules, ["id"], manifest).collect()}
    assert status == {1: "accepted", 2: "ignored", 3: "ignored", 4: "accepted"}


def test_only_automatic_rules_start(spark, form):
    events, rules = make(spark, 100)
    routed = route_events(spark.createDataFrame(events, EVENTS), spark.createDataFrame(rules, RULES))
    manual = {r[1] for r in rules if r[5] is False}
    assert {(r.id, r.job) for r in routed.collect()} == {p for p in expected_pairs(events, rules) if p[1] not in manual}


def test_physical_forms_differ(spark, form):
    events, rules = make(spark, 10)
    plan = match_pairs(spark.createDataFrame(events, EVENTS), spark.createDataFrame(rules, RULES))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in text) == (form == "broadcast")
    # Events; a large registry is grouped by itself in both of the joined forms.
    assert ("Exchange hashpartitioning(bucket#" in text) == (form == "shuffled")
    assert "NestedLoop" not in text and "Cartesian" not in text


@pytest.mark.parametrize(
    "pattern, anchor",
    [
        (r"^a/b/\d+", "a/b/"), (r"^a/b", "a/"), (r"^a/?b", ""), (r"^a/b/+c", "a/"), (r"^a/b*/c", "a/"), (r"a/b/", ""),
        (r"^a/|^c/", ""), (r"^(a|b)/", ""), (r"^a.b/c/", ""), (r"^a/{2}b/", ""),
    ],
)
def test_anchors(spark, pattern, anchor):
    assert spark.range(1).select(rule_anchor(F.lit(pattern)).alias("x")).head().x == anchor


def test_events_without_a_name(spark):
    events = spark.createDataFrame([(1, "b0", ""), (2, "b0", None), (3, "b1", ""), (4, "b0", "x")], EVENTS)
    rules = spark.createDataFrame([(0, "f", "b0", "x", "file", True), (1, "d", "b1", "^", "folder", True)], RULES)
    assert sorted(r.id for r in nameless_events(events, rules).collect()) == [1, 2]


def test_analyze_path(spark):
    rules = spark.createDataFrame(
        [
            (0, "run", "b0", r"^a/", "file", None),
            (1, "ignored", "b0", r"1", "file", False),
            (2, "pattern", "b0", r"^z", "file", True),
            (3, "bucket", "b1", r"^a/", "file", True),
            (4, "folder", "b0", r"^a/", "folder", True),
        ],
        RULES,
    )
    found = {r.name: (r["class"], r.note is not None) for r in analyze_path(rules, "b0", "a/1").collect()}
    assert found == {
        "run": ("will_run", False),
        "ignored": ("ignored", False),
        "pattern": ("no_match", False),
        "bucket": ("no_match", False),
        "folder": ("will_run", True),
    }
    noted = analyze_path(rules, "b0", "a/*").filter("name = 'folder'").head()
    assert (noted["class"], noted.note) == ("will_run", None)


OBJECTS = [("b", "a/b/1.csv"), ("b", "a/b/2.csv"), ("b", "m/"), ("b", "both"), ("b", "both/x"), ("c", "a/only")]


def is_folder(bucket, path):
    """As a listing service would answer, one question at a time."""
    names = {n for b, n in OBJECTS if b == bucket}
    path = path.strip("/")
    if not path:
        return "folder"
    if path in names:
        return "file"
    if path + "/" in names or any(n.startswith(path + "/") for n in names):
        return "folder"
    return "not_found"


def test_classes(spark):
    paths = ["", "/", "a", "a/", "/a/b/", "a/b/1.csv", "a/b/1", "a/bb", "m", "m/", "both", "both/", "both/x", "a/only", "z", None]
    probes = [(b, p) for b in ("b", "c") for p in paths]
    manifest = spark.createDataFrame(OBJECTS, "bucket string, name string")
    df = classify_paths(spark.createDataFrame(probes, "bucket string, path string"), manifest)
    assert {(r.bucket, r.path): r.path_class for r in df.collect()} == {(b, p): is_folder(b, p or "") for b, p in probes}


@pytest.mark.parametrize("limit", [0, classify.BROADCAST_PATHS])
def test_a_small_index_is_broadcast(spark, monkeypatch, limit):
    """Whatever the sizes Spark expects: paths asked for are shuffled only where the index is large."""
    monkeypatch.setattr(classify, "BROADCAST_PATHS", limit)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        manifest = spark.createDataFrame([*OBJECTS, ("b", None), (None, "a/b")] * 3, "bucket string, name string")
        asked = [("b", p) for p in ("a", "/a/", "", None, "//", "nothing", "both")] + [(None, "a"), (None, "")]
        df = classify_paths(spark.createDataFrame(asked, "bucket string, path string"), manifest)
        text = df._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in text) == (limit > 0)
        assert ("SortMergeJoin" in text) == (limit == 0)
        found = {(r.bucket, r.path): r.path_class for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    assert found == {
        ("b", "a"): "folder", ("b", "/a/"): "folder", ("b", ""): "folder", ("b", None): "folder", ("b", "//"): "folder",
        ("b", "nothing"): "not_found", ("b", "both"): "file", (None, "a"): "not_found", (None, ""): "folder",
    }


def test_resolved_paths(spark):
    requests = [
        ("folder", "a/b", "a/b", None),
        ("folder", "a/b/1.csv", None, "not a folder"),
        ("folder", "a/2*", "a/2*", None),
        ("marker", "a/b/1.csv", "a/b/", None),
        ("marker", "a/b/*.csv", "a/b/", None),
        ("marker", "a/b", None, "is a folder"),
        ("file", "a/b/1.csv", "a/b/1.csv", None),
        ("file", "a", None, "is a folder"),
        ("file", "nope", None, "path not found"),
    ]
    df = spark.createDataFrame([("b", n, m) for m, n, _, _ in requests], "bucket string, name string, mode string")
    manifest = spark.createDataFrame(OBJECTS, "bucket string, name string")
    found = {(r.mode, r.name): (r.input_path, r.error) for r in resolve_input_path(df, manifest).collect()}
    assert found == {(m, n): (path, error) for m, n, path, error in requests}


@pytest.mark.parametrize(
    "pattern, factors",
    [
        (r"^[a-z]+/daily_orders/\d{8}\.csv$", ["/daily_orders/", ".csv"]),
        (r"daily\.csv", ["daily.csv"]),
        (r"abcd+efgh", ["abcd", "efgh"]),
        (r"abcd*efgh", ["abc", "efgh"]),
        (r"abcd{0,2}efgh?", ["abc", "efg"]),
        (r"ab(c(d)?e)*?f", ["ab", "f"]),
        (r"ab(cd)ef", ["abcdef"]),
        (r"ab(cd)?ef", ["ab", "ef"]),
        (r"ab(cd)+ef", ["ab", "cd", "ef"]),
        (r"ab((c)d(e)*f)g", ["abcd", "fg"]),
        (r"ab((cd)e)*f", ["ab", "f"]),
        (r"(?P<day>\d+)/orders_(?:x|y)", []),
        (r"(?P<day>\d+)/orders_(?:xy)", ["/orders_xy"]),
        (r"(?i)orders", []),
        (r"(?=orders)x", []),
        (r"or\x41ders", []),
        (r"\Qa.b\E", []),
        (r"\p{L}orders", []),
        (r"ord[^/]ers[]a]x[\]b]y", ["ord", "ers", "x", "y"]),
        (r"a[b[c]d]e", []),
        (r"a\(bc\)d\*+e", ["a", "bc", "d", "e"]),
        (r"a\bcd\$", ["a", "cd"]),
        (r"", []),
        (None, []),
    ],
)
def test_literal_factors(spark, pattern, factors):
    found = spark.createDataFrame([(pattern,)], "p string").select(literal_factors(F.col("p")).alias("x")).head().x
    assert found == factors


def test_matches_hold_every_factor(spark):
    """Random patterns against random names: a match without a factor would be lost."""
    random.seed(23)
    atoms = ["a", "b", "/", r"\.", ".", r"\d", "[ab]", "[^a]", "(ab)", "(a|b)", "(?:b/)", "(a(b)?/)", "1", "^", "$"]
    tails = ["", "", "", "", "*", "+", "?", "{1,2}", "*?", "+?"]
    patterns = set()
    while len(patterns) < 600:
        pattern = "".join(a + ("" if a in "^$" else random.choice(tails)) for a in random.choices(atoms, k=random.randint(1, 6)))
        patterns.add(pattern)
    names = ["".join(random.choices("ab/.1", k=random.randint(0, 9))) for _ in range(1500)]
    df = spark.createDataFrame([(p,) for p in sorted(patterns)], "p string")
    kept = 0
    for row in df.select("p", literal_factors(F.col("p")).alias("factors")).collect():
        for name in names:
            if row.factors and re.search(row.p, name):
                kept += 1
                assert all(f in name for f in row.factors), (row.p, row.factors, name)
    assert kept > 10_000


def test_many_rules_without_a_folder_meet_few_events(spark):
    """10,000 rules that start with no literal folder: events meet a handful, not all."""
    n = 10_000
    rules = [(i, f"r{i}", "b0", rf"[a-z]+/feed{i:05d}x/\d+\.csv$", "file", True) for i in range(n)]
    rules.append((n, "any", "b0", r"\d\d\.\w+$", "file", True))
    events = [(i, "b0", f"in/feed{i * 37 % n:05d}x/{i}.csv") for i in range(500)]
    df, registry = spark.createDataFrame(events, EVENTS), spark.createDataFrame(rules, RULES)
    keyed, by_grams = _keyed_rules(registry)
    assert by_grams
    looked_up = df.select("id", "bucket", F.explode(_lookup_keys(F.col("name"), True)).alias("_rule_anchor"))
    candidates = looked_up.join(keyed, (F.col("bucket") == F.col("_bucket")) & (looked_up._rule_anchor == keyed._rule_anchor))
    # 5 digits and a letter leave four runs of the number's own; ten rules share the rarest.
    assert candidates.count() <= 500 * 60
    found = {(r.id, r.rule.name) for r in match_pairs(df, registry).collect()}
    assert found == {(i, f"r{i * 37 % n}") for i in range(500)} | {(i, "any") for i in range(10, 500)}


def test_rarest_run(spark):
    rows = [("b", "[a-z]alpha_one"), ("b", "[a-z]alpha_two"), ("b", "[a-z]alpha_two"), ("c", "x+y"), (None, "[a-z]beta")]
    found = {(r.b, r.p): r.gram for r in rarest_grams(spark.createDataFrame(rows, "b string, p string"), "p", "b").collect()}
    one, two = found["b", "[a-z]alpha_one"], found["b", "[a-z]alpha_two"]
    assert one in "alpha_one" and one not in "alpha_two" and two in "alpha_two" and two not in "alpha_one"
    assert ("c", "x+y") not in found
    runs = spark.createDataFrame([("abcde",), ("aaaaaa",), ("abc",), (None,)], "t string").select(grams(F.col("t")).alias("g"))
    assert [r.g for r in runs.collect()] == [["abcd", "bcde"], ["aaaa"], [], []]


def test_large_registries_shuffle_few_keys(spark, monkeypatch):
    """Of the keys of an event those go on that rules have, and no other pair is lost."""
    n = 3_000
    rules = [(i, f"r{i}", "b0", rf"[a-z]+/feed{i:05d}x/\d+\.csv$", "file", True) for i in range(n)]
    rules += [(n, "short", "b0", r"\d/abcd\d", "file", True), (n + 1, "any", "b0", r"\d\d\.\w+$", "file", True)]
    rules += [(n + 2, "anchored", "b0", "^in/feed00037x/", "folder", True)]
    events = [(i, "b0", f"in/feed{i * 37 % n:05d}x/{i}.csv") for i in range(500)] + [(500, "b0", "7/abcd7"), (501, None, "7/abcd7")]
    df, registry = spark.createDataFrame(events, EVENTS), spark.createDataFrame(rules, RULES)
    patterns, sizes = _keyed_rules(registry)
    assert sizes == [4, 8]
    keyed = df.select("*", F.explode(_lookup_keys(F.col("name"), sizes)).alias("_anchor"))
    kept = routing._rules_keys_only(keyed, patterns, len(rules), "bucket")
    # No key and the key of its rule, and now and then another one's.
    assert keyed.count() > 500 * 30 and kept.count() < 500 * 5
    for name in ("INLINE_RULES", "BROADCAST_RULES", "FILTERED_RULES"):
        monkeypatch.setattr(routing, name, 0)
    pairs = match_pairs(df, registry)
    assert "BroadcastHashJoin" in pairs._jdf.queryExecution().executedPlan().toString()
    found = {(r.id, r.rule.name) for r in pairs.collect()}
    wanted = {(i, f"r{i * 37 % n}") for i in range(500)} | {(i, "any") for i in range(10, 500)}
    assert found == wanted | {(500, "short")} | {(i, "anchored") for i in range(500) if i * 37 % n == 37}


def test_filtered_pairs(spark, monkeypatch):
    for name in ("INLINE_RULES", "BROADCAST_RULES", "FILTERED_RULES"):
        monkeypatch.setattr(routing, name, 0)
    monkeypatch.setattr(routing, "FILTER_WORDS", 2)
    events, rules = make(spark)
    found = [(r.id, r.rule.name) for r in match_pairs(spark.createDataFrame(events, EVENTS), spark.createDataFrame(rules, RULES)).collect()]
    assert len(found) == len(set(found)) and set(found) == expected_pairs(events, rules)
