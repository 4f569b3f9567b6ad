"""Run status, partition summaries and other reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.partitions import partition_name


def run_status(runs: DataFrame) -> DataFrame:
    """Completion and success of runs with a ``state`` and ``graph.nodes``.

    A run is complete when it is done and successful when then no node failed;
    success is unknown until completion.
    """
    nodes = F.coalesce("graph.nodes", F.array())
    completed = F.coalesce(F.col("state") == "DONE", F.lit(False))
    failed = F.exists(nodes, lambda node: F.coalesce(node["state"] == "FAILED", F.lit(False)))
    return runs.withColumn("is_completed", completed).withColumn(
        "is_successful", F.when(F.col("is_completed"), ~failed)
    )


def run_status_flat(nodes: DataFrame, run: str = "run", state: str = "state", run_state: str = "run_state") -> DataFrame:
    """The same from one row per node; nodes never meet in one place, only flags do."""
    completed = F.coalesce(F.bool_or(F.col(run_state) == "DONE"), F.lit(False))
    failed = F.coalesce(F.bool_or(F.col(state) == "FAILED"), F.lit(False))
    return nodes.groupBy(run).agg(
        completed.alias("is_completed"), F.when(completed, ~failed).alias("is_successful")
    )


def failed_nodes(runs: DataFrame, run: str = "run") -> DataFrame:
    """One row per failed node of a run, with its error."""
    failed = F.filter("graph.nodes", lambda node: node["state"] == "FAILED")
    return runs.select(run, F.explode(failed).alias("node")).select(run, "node.*")


def distinct_partitions(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def partition_summary(df: DataFrame, column: str, granularity: str) -> DataFrame:
    """Rows and value range of every partition in the input."""
    return df.groupBy(partition_name(F.col(column), granularity).alias("part_id")).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(column).alias("min_value"),
        F.max(column).alias("max_value"),
    )


def count_expired(ledger: DataFrame, now: Column, max_age_micros: int) -> DataFrame:
    """How many ledger records are older than the limit."""
    old = F.unix_micros("created_at") < F.unix_micros(now) - F.lit(max_age_micros)
    return ledger.agg(F.count_if(old).alias("deleted_count"))
