"""Which rules an object event starts: equal bucket, regex found in the name.

Small registries (the usual case) become literal patterns: every pattern is
compiled once per task, matching needs no join and no shuffle, and each event
stays one row with an array of its rules.

Larger registries are joined. Joining on the bucket alone would try every rule
of a bucket on every one of its events, so each rule also gets an *anchor*: the
literal folder its pattern starts with. Events look up the folders above their
name, and the regex runs only on those candidates. A rule that starts with no
literal folder is looked up by eight literal characters, or four, that its matches
hold somewhere, those that the fewest rules of the bucket have (``factors``). Only
rules without such characters meet every event of their bucket.

Most keys of an event are no rule's. Where a registry is too large to be broadcast,
a filter of its keys is, so that only keys that may be a rule's are shuffled.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from ..functions.paths import ancestor_folders, has_wildcards
from ..options import translated_regex
from .classify import classify_paths
from .factors import SIZES, grams, literal_factors, rarest_grams, run_size

# A registry up to this many rules is written into the plan.
INLINE_RULES = 64
# A registry up to this many rules may be broadcast (a few hundred bytes each).
BROADCAST_RULES = 100_000
# A larger one has its keys filtered from this many rules on; four share a word of the filter.
FILTERED_RULES = 100_000
KEYS_PER_WORD = 4
# The filter's words take some 50 MB; beyond that it lets more keys pass, and loses none.
FILTER_WORDS = 2_000_000

# Marks keys that are literal characters; no folder starts with it.
_GRAM_KEY = "*"

_MATCH = "struct<ordinal:bigint,name:string,mode:string,auto_trigger:boolean>"

# ``^`` and whole literal segments, each followed by a plain slash.
_ANCHOR = r"^\^((?:[A-Za-z0-9_ -]+/(?![?*+{]))+)"


def rule_anchor(pattern: Column) -> Column:
    """The folder every match must start with, or ``''`` if none is certain.

    Alternation could bypass the prefix, so such patterns get none.
    """
    return F.when(pattern.contains("|"), F.lit("")).otherwise(F.regexp_extract(pattern, _ANCHOR, 1))


def _java_pattern(pattern: Column) -> Column:
    """``translated_regex`` for patterns that stand in a column."""
    groups = F.replace(pattern, F.lit("(?P<"), F.lit("(?<"))
    return F.regexp_replace(groups, r"\(\?P=(\w+)\)", r"\\k<$1>")


def registry_size(rules: DataFrame, limit: int) -> int:
    """Number of rules, counting no further than just past ``limit``."""
    return rules.limit(limit + 1).count()


def with_ordinal(rules: DataFrame) -> DataFrame:
    """Registry order as a column, for rules that do not carry one."""
    if "ordinal" in rules.columns:
        return rules
    return rules.withColumn("ordinal", F.monotonically_increasing_id())


def _inline_rules(rules: DataFrame) -> list[Row] | None:
    """The rules of a small registry, in order; None for a larger one."""
    columns = ("ordinal", "name", "source_bucket", "source_prefix", "mode", "auto_trigger")
    listed = rules.select(*columns).limit(INLINE_RULES + 1).collect()
    return None if len(listed) > INLINE_RULES else sorted(listed, key=lambda rule: rule.ordinal)


def _inline_hits(events: DataFrame, listed: list[Row], bucket: str, name: str) -> tuple[DataFrame, Column]:
    """Events with ``_hits``, positions in the returned constant array of rules.

    Positions are plain integers, so matching stays inside generated code.
    """
    by_bucket: dict[str, list[tuple[int, Row]]] = {}
    for position, rule in enumerate(listed):
        by_bucket.setdefault(rule.source_bucket, []).append((position, rule))
    text = F.coalesce(F.col(name), F.lit(""))
    named = text != ""
    hits = F.lit(None).cast("array<int>")
    for source_bucket, group in by_bucket.items():
        tests = []
        for position, rule in group:
            found = F.rlike(text, F.lit(translated_regex(rule.source_prefix)))
            # A file or marker rule needs a name to look at.
            found = found if rule.mode == "folder" else named & found
            tests.append(F.when(found, F.lit(position)).otherwise(F.lit(-1)))
        hits = F.when(F.col(bucket) == source_bucket, F.array_remove(F.array(*tests), F.lit(-1))).otherwise(hits)
    constant = [
        {"ordinal": rule.ordinal, "name": rule.name, "mode": rule.mode, "auto_trigger": rule.auto_trigger is not False}
        for rule in listed
    ]
    entries = F.from_json(F.lit(json.dumps(constant)), f"array<{_MATCH}>")
    return events.withColumn("_hits", F.coalesce(hits, F.array().cast("array<int>"))), entries


def _keyed_rules(rules: DataFrame) -> tuple[DataFrame, list[int]]:
    """Rules by bucket and key, and the lengths of keys that are literal characters."""
    anchored = rules.withColumn("_rule_anchor", rule_anchor(F.col("source_prefix")))
    loose = anchored.filter(F.col("_rule_anchor") == "")
    rare = rarest_grams(loose, "source_prefix", "source_bucket").select(
        F.col("source_bucket").alias("_gram_bucket"),
        F.col("source_prefix").alias("_gram_prefix"),
        F.concat(F.lit(_GRAM_KEY), "gram").alias("_gram"),
    )
    found = loose.select(run_size(literal_factors(F.col("source_prefix"))).alias("size")).distinct().collect()
    sizes = [row.size for row in found if row.size]
    if sizes:
        same = (F.col("source_bucket") == F.col("_gram_bucket")) & (F.col("source_prefix") == F.col("_gram_prefix"))
        found = F.when(F.col("_rule_anchor") == "", F.col("_gram"))
        anchored = anchored.join(rare, same, "left").withColumn("_rule_anchor", F.coalesce(found, "_rule_anchor"))
    keyed = anchored.select(
        F.col("source_bucket").alias("_bucket"),
        "_rule_anchor",
        _java_pattern(F.col("source_prefix")).alias("_pattern"),
        F.struct(
            F.col("ordinal").cast("bigint").alias("ordinal"),
            "name",
            "mode",
            F.coalesce("auto_trigger", F.lit(True)).alias("auto_trigger"),
        ).alias("rule"),
    )
    return keyed, sorted(sizes)


def _lookup_keys(text: Column, sizes: list[int] | bool) -> Column:
    """What an event is looked up by: no key, the folders above it, its runs of given lengths or all."""
    folders = F.transform(ancestor_folders(text), lambda folder: F.concat(folder, F.lit("/")))
    keys = F.concat(F.array(F.lit("")), folders)
    for size in SIZES if sizes is True else sizes or ():
        keys = F.concat(keys, F.transform(grams(text, size), lambda gram: F.concat(F.lit(_GRAM_KEY), gram)))
    return keys


def _filter_bits(bucket: str, key: str, words: int) -> tuple[Column, Column]:
    """A key's word in the filter, and the three bits that it sets there."""
    mixed = F.xxhash64(bucket, key)
    bits = (F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(mixed, n).bitwiseAND(63).cast("int")) for n in (40, 46, 52))
    first, second, third = bits
    return F.pmod(mixed, F.lit(words)), first.bitwiseOR(second).bitwiseOR(third)


def _rules_keys_only(keyed: DataFrame, patterns: DataFrame, n_rules: int, bucket: str) -> DataFrame:
    """Keyed events without most keys that no rule has: a Bloom filter, one word of it for a key."""
    words = max(1, min(n_rules // KEYS_PER_WORD, FILTER_WORDS))
    word, bits = _filter_bits("_bucket", "_rule_anchor", words)
    held = patterns.select(word.alias("_word"), bits.alias("_bits")).groupBy("_word").agg(F.bit_or("_bits").alias("_held"))
    word, bits = _filter_bits(bucket, "_anchor", words)
    asked = keyed.withColumns({"_asked": word, "_bits": bits})
    known = (F.col("_asked") == F.col("_word")) & (F.col("_held").bitwiseAND(F.col("_bits")) == F.col("_bits"))
    return asked.join(F.broadcast(held), known).select(*keyed.columns)


def match_pairs(
    events: DataFrame,
    rules: DataFrame,
    bucket: str = "bucket",
    name: str = "name",
    salts: int = 16,
) -> DataFrame:
    """One row per event and rule that match, as ``(event columns, rule struct)``."""
    rules = with_ordinal(rules)
    listed = _inline_rules(rules)
    if listed is not None:
        marked, entries = _inline_hits(events, listed, bucket, name)
        # The outer form, as the plain one would test every pattern twice: once more
        # in the filter that is inferred for it.
        hit = marked.select(*events.columns, F.explode_outer("_hits").alias("_hit"))
        return hit.filter(F.col("_hit").isNotNull()).select(*events.columns, F.get(entries, F.col("_hit")).alias("rule"))

    text = F.coalesce(F.col(name), F.lit(""))
    patterns, sizes = _keyed_rules(rules)
    keyed = events.select("*", F.explode(_lookup_keys(text, sizes)).alias("_anchor"))
    same = (F.col(bucket) == F.col("_bucket")) & (F.col("_anchor") == F.col("_rule_anchor"))
    # A file or marker rule needs a name to look at.
    found = F.rlike(text, F.col("_pattern")) & ((F.col("rule.mode") == "folder") | (text != ""))
    if registry_size(rules, BROADCAST_RULES) <= BROADCAST_RULES:
        joined = keyed.join(F.broadcast(patterns), same & found)
    else:
        # Too many rules to ship everywhere: shuffle both sides. A bucket's events
        # spread over several keys, so a hot bucket does not land on one task.
        if registry_size(rules, FILTERED_RULES) > FILTERED_RULES:
            keyed = _rules_keys_only(keyed, patterns, rules.count(), bucket)
        keyed = keyed.withColumn("_salt", F.pmod(F.xxhash64(name), F.lit(salts)).cast("int"))
        spread = patterns.withColumn("_rule_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        joined = keyed.join(spread, same & (F.col("_salt") == F.col("_rule_salt")) & found)
    return joined.select(*events.columns, "rule")


def with_matches(
    events: DataFrame,
    rules: DataFrame,
    event_key: list[str],
    bucket: str = "bucket",
    name: str = "name",
    manifest: DataFrame | None = None,
) -> DataFrame:
    """Events with ``matches``, the array of their rules in registry order.

    ``event_key`` may repeat and may be null: what matches depends on bucket and name
    alone. With a manifest, folder rules also need the event's path to be a folder.
    """
    matched = _with_matches(events, rules, bucket, name)
    return matched if manifest is None else _folders_checked(matched, manifest, bucket, name)


def _folders_checked(matched: DataFrame, manifest: DataFrame, bucket: str, name: str) -> DataFrame:
    path = F.coalesce(F.col(name), F.lit(""))
    asked = matched.filter(F.exists("matches", lambda m: m["mode"] == "folder"))
    probes = asked.select(F.col(bucket).alias("bucket"), path.alias("path")).distinct()
    folders = (
        classify_paths(probes, manifest)
        .filter(has_wildcards(F.col("path")) | (F.col("path_class") == "folder"))
        .select(F.col("bucket").alias("_folder_bucket"), F.col("path").alias("_folder"))
    )
    kept = F.filter("matches", lambda m: ~m["mode"].eqNullSafe(F.lit("folder")) | F.col("_folder").isNotNull())
    return (
        matched.join(folders, (F.col(bucket) == F.col("_folder_bucket")) & (path == F.col("_folder")), "left")
        .withColumn("matches", kept)
        .drop("_folder_bucket", "_folder")
    )


def _with_matches(events: DataFrame, rules: DataFrame, bucket: str, name: str) -> DataFrame:
    rules = with_ordinal(rules)
    listed = _inline_rules(rules)
    if listed is not None:
        marked, entries = _inline_hits(events, listed, bucket, name)
        found = F.transform("_hits", lambda hit: F.get(entries, hit))
        return marked.withColumn("matches", found).drop("_hits")
    # Every object is matched once, however many events name it. Its array is bounded by
    # the registry, not by the events.
    text = F.coalesce(F.col(name), F.lit(""))
    found = (
        match_pairs(events.select(F.col(bucket).alias("_in"), text.alias("_text")).distinct(), rules, "_in", "_text")
        .groupBy("_in", "_text")
        .agg(F.array_sort(F.collect_list("rule")).alias("matches"))
    )
    empty = F.array().cast(f"array<{_MATCH}>")
    joined = events.join(found, (F.col(bucket) == F.col("_in")) & (text == F.col("_text")), "left")
    return joined.drop("_in", "_text").withColumn("matches", F.coalesce("matches", empty))


def _folder_pairs(events: DataFrame, rules: DataFrame, manifest: DataFrame, bucket: str, name: str) -> DataFrame:
    """Pairs of folder rules whose path is a folder, or holds a wildcard."""
    pairs = match_pairs(events, rules, bucket, name)
    probes = pairs.select(F.struct(*pairs.columns).alias("_pair"), F.col(bucket).alias("bucket"), F.col(name).alias("path"))
    kept = classify_paths(probes, manifest).filter(has_wildcards(F.coalesce("path", F.lit(""))) | (F.col("path_class") == "folder"))
    return kept.select("_pair.*")


def route_events(
    events: DataFrame,
    rules: DataFrame,
    manifest: DataFrame | None = None,
    bucket: str = "bucket",
    name: str = "name",
) -> DataFrame:
    """Every event with every rule it starts (columns ``job``, ``mode``, ``ordinal``).

    With a manifest, folder rules also need the event's path to be a folder.
    """
    started = with_ordinal(rules).filter(F.coalesce("auto_trigger", F.lit(True)))
    folder_rules = started.filter("mode = 'folder'")
    if manifest is None or registry_size(folder_rules, 0) == 0:
        pairs = match_pairs(events, started, bucket, name)
    else:
        # Only the pairs of folder rules have to meet the listing.
        pairs = match_pairs(events, started.filter("NOT (mode <=> 'folder')"), bucket, name).unionByName(
            _folder_pairs(events, folder_rules, manifest, bucket, name)
        )
    return pairs.select(
        *events.columns,
        F.col("rule.name").alias("job"),
        F.col("rule.mode").alias("mode"),
        F.col("rule.ordinal").alias("ordinal"),
    )


def resolve_single_job(
    events: DataFrame, rules: DataFrame, event_key: list[str], manifest: DataFrame | None = None
) -> DataFrame:
    """The one rule of an event, manual rules included; several or none is an error."""
    n = F.size("matches")
    return (
        with_matches(events, rules, event_key, manifest=manifest)
        .withColumn("n_matches", n)
        .withColumn("job", F.when(n == 1, F.col("matches")[0]["name"]))
        .withColumn("error", F.when(n == 0, F.lit("not found")).when(n > 1, F.lit("multiple matches")))
        .drop("matches")
    )


def analyze_path(rules: DataFrame, bucket: str, name: str) -> DataFrame:
    """Every rule, and whether one given path would start it, with the reason."""
    hit = F.rlike(F.lit(name), _java_pattern(F.col("source_prefix")))
    auto = F.coalesce("auto_trigger", F.lit(True))
    other_bucket = F.col("source_bucket") != bucket
    folder_note = (F.col("mode") == "folder") & ~has_wildcards(F.lit(name)) & ~other_bucket & hit
    return rules.select(
        "name",
        "source_bucket",
        "source_prefix",
        "mode",
        auto.alias("auto_trigger"),
        F.when(other_bucket | ~hit, "no_match").when(auto, "will_run").otherwise("ignored").alias("class"),
        F.when(other_bucket, F.concat(F.lit("bucket mismatch: expects "), F.col("source_bucket")))
        .when(~hit, F.concat(F.lit("pattern mismatch: "), F.col("source_prefix")))
        .when(auto, F.lit("pattern matches, started by events"))
        .otherwise(F.lit("pattern matches, manual only"))
        .alias("reason"),
        F.when(folder_note, F.lit("folder check happens at run time")).alias("note"),
    )


def analyze_matches(events: DataFrame, rules: DataFrame, event_key: list[str]) -> DataFrame:
    """Per event: the rules that will run, those ignored, and how many fail and why.

    Rules of other buckets are counted, not listed: a row for every event and rule
    would repeat the registry once per event.
    """
    per_bucket = rules.groupBy(F.col("source_bucket").alias("bucket")).agg(F.count(F.lit(1)).alias("n_bucket_rules"))
    total = rules.agg(F.count(F.lit(1)).alias("n_rules"))
    if registry_size(per_bucket, BROADCAST_RULES) <= BROADCAST_RULES:
        per_bucket = F.broadcast(per_bucket)
    names = lambda keep: F.transform(F.filter("matches", keep), lambda m: m["name"])
    in_bucket = F.coalesce("n_bucket_rules", F.lit(0))
    n_rules = total.first().n_rules
    return (
        with_matches(events, rules, event_key)
        .join(per_bucket, "bucket", "left")
        .select(
            *events.columns,
            names(lambda m: m["auto_trigger"]).alias("will_run"),
            names(lambda m: ~m["auto_trigger"]).alias("ignored"),
            (in_bucket - F.size("matches")).alias("n_pattern_mismatch"),
            (F.lit(n_rules) - in_bucket).alias("n_bucket_mismatch"),
        )
    )


def match_counts(analysis: DataFrame) -> DataFrame:
    """Event and rule pairs per class, from the output of ``analyze_matches``."""
    sums = analysis.agg(
        F.sum(F.size("will_run")).alias("will_run"),
        F.sum(F.size("ignored")).alias("ignored"),
        F.sum(F.col("n_pattern_mismatch") + F.col("n_bucket_mismatch")).alias("no_match"),
    )
    return sums.select(F.stack(
        F.lit(3),
        F.lit("will_run"), F.col("will_run"),
        F.lit("ignored"), F.col("ignored"),
        F.lit("no_match"), F.col("no_match"),
    ).alias("class", "n"))


def multi_match(events: DataFrame, rules: DataFrame, event_key: list[str]) -> DataFrame:
    """Events that start more than one rule, with the rules' names in order."""
    started = rules.filter(F.coalesce("auto_trigger", F.lit(True)))
    return (
        with_matches(events, started, event_key)
        .filter(F.size("matches") > 1)
        .select(*events.columns, F.transform("matches", lambda m: m["name"]).alias("jobs"))
    )


def event_disposition(
    events: DataFrame, rules: DataFrame, event_key: list[str], manifest: DataFrame | None = None
) -> DataFrame:
    """``accepted`` if some rule starts, else ``ignored``."""
    started = rules.filter(F.coalesce("auto_trigger", F.lit(True)))
    return with_matches(events, started, event_key, manifest=manifest).select(
        *events.columns,
        F.when(F.size("matches") > 0, F.lit("accepted")).otherwise(F.lit("ignored")).alias("status"),
    )


def nameless_events(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Events without a name in a bucket whose file or marker rules need one."""
    empty = events.filter(F.coalesce(F.col("name"), F.lit("")) == "")
    demanding = rules.filter(F.col("mode").isin("file", "marker")).select(F.col("source_bucket").alias("bucket")).distinct()
    return empty.join(demanding, "bucket", "left_semi").withColumn("error", F.lit("file name required"))


def lookup_by_name(names: DataFrame, registry: DataFrame, name: str = "name") -> DataFrame:
    """Registry entries by name; ``found`` tells the ones that do not exist."""
    entries = registry.withColumn("_found", F.lit(True))
    return names.join(entries, name, "left").withColumn("found", F.coalesce("_found", F.lit(False))).drop("_found")
