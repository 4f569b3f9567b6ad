"""Gradient-boosted trees over few-valued features, fitted from counts, scored in SQL.

What is fitted on is a table of distinct feature vectors with their counts: it holds every
row of the corpus, and its size is bounded by the product of the features' levels. The
model is a sum of nested CASE expressions.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 40
RATE = 0.3
RIDGE = 1.0


@dataclass
class Tree:
    """A split ``feature <= level``, or a leaf."""

    value: float = 0.0
    feature: int = -1
    level: int = 0
    below: "Tree | None" = None
    above: "Tree | None" = None

    def column(self, features: list[Column]) -> Column:
        if self.feature < 0:
            return F.lit(float(self.value))
        test = features[self.feature] <= self.level
        return F.when(test, self.below.column(features)).otherwise(self.above.column(features))

    def predict(self, x: np.ndarray) -> np.ndarray:
        if self.feature < 0:
            return np.full(len(x), self.value)
        return np.where(x[:, self.feature] <= self.level, self.below.predict(x), self.above.predict(x))


def _grow(x: np.ndarray, gradient: np.ndarray, curve: np.ndarray, depth: int) -> Tree:
    gain_of = lambda g, h: g * g / (h + RIDGE)
    whole = gain_of(gradient.sum(), curve.sum())
    best = (1e-6, -1, 0)
    for feature in range(x.shape[1] if depth else 0):
        for level in np.unique(x[:, feature])[:-1].tolist():
            left = x[:, feature] <= level
            gain = gain_of(gradient[left].sum(), curve[left].sum()) + gain_of(gradient[~left].sum(), curve[~left].sum())
            if gain - whole > best[0]:
                best = (gain - whole, feature, level)
    if best[1] < 0:
        return Tree(RATE * gradient.sum() / (curve.sum() + RIDGE))
    left = x[:, best[1]] <= best[2]
    parts = (_grow(x[side], gradient[side], curve[side], depth - 1) for side in (left, ~left))
    return Tree(0.0, best[1], best[2], *parts)


@dataclass
class Boosted:
    start: float
    trees: list[Tree]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.start + sum((t.predict(x) for t in self.trees), np.zeros(len(x)))

    def column(self, features: list[Column]) -> Column:
        total = F.lit(float(self.start))
        for tree in self.trees:
            total = total + tree.column(features)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def boost(x: np.ndarray, positive: np.ndarray, count: np.ndarray, depth: int = 2, rounds: int = ROUNDS) -> Boosted:
    """Fit on feature vectors ``x`` with ``positive`` of ``count`` rows labelled 1."""
    share = (positive.sum() + 0.5) / (count.sum() + 1.0)
    model = Boosted(float(np.log(share / (1 - share))), [])
    margin = np.full(len(x), model.start)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        tree = _grow(x, positive - count * p, count * p * (1 - p), depth)
        model.trees.append(tree)
        margin = margin + tree.predict(x)
    return model


def threshold(p: np.ndarray, positive: np.ndarray, count: np.ndarray, precision: float) -> float:
    """The lowest score from which on at least ``precision`` of the rows are labelled 1; above 1 if none is."""
    order = np.argsort(-p, kind="stable")
    hits, rows = np.cumsum(positive[order]), np.cumsum(count[order])
    last = np.append(np.diff(p[order]) != 0, True)
    good = np.flatnonzero(last & (hits >= precision * rows))
    return float(p[order][good[-1]]) if len(good) else 2.0
