"""The registered queries of these operators, each over the whole of its table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from dockline.session import configure

from . import (
    bpe,
    collocations,
    fingerprints,
    licences,
    linededup,
    neardup,
    packing,
    periods,
    pii,
    quality,
    sharding,
    topk,
    toxicity,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: run(configure(spark), sf_dir)
        if sql is not None:
            ORACLE[name] = sql
        return run

    return register


@query("op1_exact_top_k", topk.SQL)
def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


@query("op2_line_dedup")
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text after the deletion of repeated blocks."""
    cut = linededup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "lines_removed", "emptied", "text")


@query("op3_toxicity")
def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op4_sharding")
def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(table(spark, sf_dir, "documents"))


@query("op5_near_dedup", neardup.SQL)
def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


@query("op6_bpe")
def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


@query("op7_quality_rules", quality.SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


@query("op8_packing")
def packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op9_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query("op10_licences")
def licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def with_period(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """In every tenth document by checksum, the end is made to repeat; rows without an id stay."""
    checksum = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if checksum % 10 or not words:
        return words
    g, n = checksum // 10, len(words)
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    return words[:first] + [words[first + i % period] for i in range(n - first)]


@query("op11_periodic_runs")
def periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periods.digests(periods.periodic_runs(table(spark, sf_dir, "documents"), rewrite=with_period))


@query("op12_collocations", collocations.SQL)
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


@query("op13_fingerprints")
def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))
