"""Connected components of a links table, as joins and grouped minima."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

# Labels halve the distance to their root each round; 2^60 nodes would not need more.
MAX_ROUNDS = 120
# So many links, 16 bytes each, are settled by one task instead of by rounds of joins.
FEW_LINKS = 500_000


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``: the smallest node reachable.

    Each round takes the smallest label among the neighbours, then the label of that
    label. Minima are combined before the shuffle, so a node with very many links costs no
    more than its links. After a round the links are contracted to those between different
    labels; once there are ``FEW_LINKS`` at most, one task settles them. Nodes without links
    are not listed; an empty table gives none.
    """
    pairs = links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct()
    left = stored(pairs, label)
    labels = None
    for _ in range(MAX_ROUNDS):
        if left.count() <= FEW_LINKS:
            return _relabelled(labels, _settled(left), label)
        step = _hooked(left, label)
        labels = _relabelled(labels, step, label)
        ends = (step.select(F.col("node").alias(x), F.col("component").alias(f"c{x}")) for x in "ab")
        moved = left
        for x, end in zip("ab", ends):
            moved = moved.join(end, x)
        moved = moved.select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b"))
        left = stored(moved.where("a <> b").distinct(), label)
    raise RuntimeError("components did not settle")


def _hooked(links: DataFrame, label: str) -> DataFrame:
    """Every node with a smaller node it is connected to, or itself if its neighbours are larger.

    A node takes its least neighbour, then what that one took, twice.
    """
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
    labels = stored(least.select("node", F.least("node", "b").alias("component")), label)
    for _ in range(2):
        up = labels.select(F.col("node").alias("component"), F.col("component").alias("higher"))
        labels = stored(labels.join(up, "component").select("node", F.col("higher").alias("component")), label)
    return labels


def _relabelled(labels: DataFrame | None, step: DataFrame, label: str) -> DataFrame:
    if labels is None:
        return stored(step, label)
    onward = step.select(F.col("node").alias("component"), F.col("component").alias("next"))
    return stored(labels.join(onward, "component", "left").select("node", F.coalesce("next", "component").alias("component")), label)


def _settled(links: DataFrame) -> DataFrame:
    """The components of a few links, in one task."""

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(b.column("a").to_numpy(zero_copy_only=False), b.column("b").to_numpy(zero_copy_only=False)) for b in batches]
        if not parts:
            return
        a, b = (np.concatenate(x) for x in zip(*parts))
        nodes, place = np.unique(np.concatenate([a, b]), return_inverse=True)
        low, high, top = place[: len(a)], place[len(a) :], np.arange(len(nodes))
        while len(low):
            low, high = top[low], top[high]
            apart = low != high
            low, high = np.minimum(low[apart], high[apart]), np.maximum(low[apart], high[apart])
            np.minimum.at(top, high, low)
            while (top[top] != top).any():
                top = top[top]
        yield pa.record_batch([pa.array(nodes, pa.int64()), pa.array(nodes[top], pa.int64())], ["node", "component"])

    return links.coalesce(1).mapInArrow(join, "node bigint, component bigint")
