"""Object events as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators.routing import route_events
from ..sources.events import parse_events, valid_events


def event_stream(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """One row of text per event, from files that arrive in a folder."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def routed_stream(events: DataFrame, rules: DataFrame) -> DataFrame:
    """Valid events of a text stream with the rules they start.

    The rules are read once, when the query starts.
    """
    return route_events(valid_events(parse_events(events)), rules)
