"""Exact top-k search by inner product with a pivot table.

Vectors are turned into integers, floor(1024 x). Since
``q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2``, a lower bound of the distance ``|q - x|`` is an
upper bound of the score. The table holds the distance of every vector to many pivots;
the largest difference ``|d(q, p) - d(x, p)|`` over all pivots is such a lower bound. For a
query, candidates are evaluated in the order of their bounds, until the tenth best score
is above every bound that is left: the result is exact whatever the pivots are.

Queries and candidates are dealt into blocks by hash; a task holds one block of each.
Every block pair gives its best k, the best of which are ranked per query.

Vectors that are null, or hold null or non-finite components, and rows without an id take
no part. Only vectors of one length are compared. A query's own row is the one with its
id: rows that repeat an id are one vector if equal, and otherwise each a candidate for the
other ids. Ties go to the smaller id. Components beyond 2^31 are compared without pivots,
in 64-bit integers. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

PIVOTS = 24
# Pivots are picked from so many vectors at most; they only steer the order of evaluation.
PIVOT_SAMPLE = 2_000
QUERY_BLOCK = 4_096
CANDIDATE_BLOCK = 2_048
# Candidates evaluated at once, in the order of their bounds.
STEP = 64
# Sums of products up to here are exact in doubles.
EXACT = float(1 << 52)


def integers(embedding: str = "embedding"):
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * 1024))


def usable(embedding: str = "embedding"):
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.col(embedding).isNotNull() & ~F.coalesce(bad, F.lit(False))


def far_apart(vectors: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first choice of ``count`` rows."""
    chosen = [0]
    nearest = ((vectors - vectors[0]) ** 2).sum(axis=1)
    while len(chosen) < min(count, len(vectors)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((vectors - vectors[chosen[-1]]) ** 2).sum(axis=1))
    return vectors[chosen]


def choose_pivots(vectors: DataFrame) -> dict[int, np.ndarray]:
    """Pivots by vector length, from a bounded sample in hash order."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(PIVOT_SAMPLE).collect()
    by_length: dict[int, list] = {}
    for row in sample:
        by_length.setdefault(len(row.v), []).append(row.v)
    return {n: far_apart(np.array(rows, np.float64).reshape(len(rows), n), PIVOTS) for n, rows in by_length.items()}


def _matrix(column: pa.Array, kind) -> np.ndarray:
    rows = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False) if rows else np.zeros(0)
    return flat.astype(kind, copy=False).reshape(rows, len(flat) // rows if rows else 0)


def best_of_block(queries, candidates, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Row numbers of queries and their best candidates, the scores, and rows evaluated."""
    q_ids, q, q_table = queries
    c_ids, c, c_table = candidates
    top = max(np.abs(q).max(initial=0), np.abs(c).max(initial=0))
    exact = float(top) ** 2 * max(q.shape[1], 1) * 4 < EXACT
    found_q, found_c, scores, done = [], [], [], 0
    if exact:
        qf, cf = q.astype(np.float64), c.astype(np.float64)
        q_square, c_square = (qf**2).sum(axis=1), (cf**2).sum(axis=1)
    for i in range(len(q_ids)):
        own = c_ids == q_ids[i]
        if exact and q_table.shape[1]:
            low = np.abs(c_table - q_table[i]).max(axis=1)
            # Distances are rounded; the slack keeps the bound above the true score.
            bound = (q_square[i] + c_square - low * low) / 2 + 1 + 1e-9 * (q_square[i] + c_square)
        else:
            bound = np.full(len(c_ids), np.inf)
        bound[own] = -np.inf
        order = np.argsort(-bound, kind="stable")[: len(c_ids) - int(own.sum())]
        kept_ids, kept_scores, kept_rows = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        at, step = 0, max(STEP, k)
        while at < len(order):
            if len(kept_scores) == k and kept_scores[-1] > bound[order[at]]:
                break
            rows = order[at : at + step]
            score = (cf[rows] @ qf[i]).astype(np.int64) if exact else c[rows] @ q[i]
            ids = np.concatenate([kept_ids, c_ids[rows]])
            score = np.concatenate([kept_scores, score])
            rows = np.concatenate([kept_rows, rows])
            best = np.lexsort((ids, -score))[:k]
            kept_ids, kept_scores, kept_rows = ids[best], score[best], rows[best]
            at, step = at + step, step * 2
        done += min(at, len(order))
        found_q.append(np.full(len(kept_rows), i))
        found_c.append(kept_rows)
        scores.append(kept_scores)
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    return join(found_q), join(found_c), join(scores), done


def top_k(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the rows whose id is divisible by ``every``."""
    whole = stored(
        vectors.where(usable() & F.col("vec_id").isNotNull())
        .select(F.col("vec_id").cast("bigint").alias("vec_id"), integers().alias("v"))
        .dropDuplicates(),
        "topk-vectors",
    )
    pivots = choose_pivots(whole)

    def distances(batches):
        for batch in batches:
            rows = []
            for v in batch.column("v"):
                x = np.array(v.as_py(), np.float64)
                p = pivots.get(len(x))
                rows.append([] if p is None else np.sqrt(((p - x) ** 2).sum(axis=1)))
            yield batch.append_column("d", pa.array(rows, pa.list_(pa.float64())))

    tabled = stored(whole.mapInArrow(distances, "vec_id bigint, v array<bigint>, d array<double>"), "topk-pivots")
    tabled = tabled.withColumn("length", F.size("v"))
    asked = tabled.where(F.col("vec_id") % every == 0)
    q_blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    c_blocks = max(1, -(-tabled.count() // CANDIDATE_BLOCK))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n))
    left = asked.withColumn("qb", block(q_blocks)).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(c_blocks - 1))))
    right = tabled.withColumn("cb", block(c_blocks)).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    cell = [F.col("qb").cast("bigint"), F.col("cb").cast("bigint"), F.col("length")]

    def search(one: pa.Table, two: pa.Table) -> pa.Table:
        sides = []
        for side in (one, two):
            side = side.combine_chunks()
            v = _matrix(side.column("v").combine_chunks(), np.int64)
            d = _matrix(side.column("d").combine_chunks(), np.float64)
            sides.append((side.column("vec_id").to_numpy(), v, d))
        i, j, score, _ = best_of_block(*sides, k)
        return pa.table(
            {
                "query_id": pa.array(sides[0][0][i], pa.int64()),
                "vec_id": pa.array(sides[1][0][j], pa.int64()),
                "score": pa.array(score, pa.int64()),
            }
        )

    found = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInArrow(search, "query_id bigint, vec_id bigint, score bigint")
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )


SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
  WHERE q.vec_id % 100 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
