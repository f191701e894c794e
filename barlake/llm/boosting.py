"""Gradient-boosted trees over a table of distinct feature vectors: fitted on the
driver from grouped counts, applied as one column expression."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

#: Rounds, depth of a tree, step, and the weight that a leaf needs and is shrunk by.
ROUNDS, DEPTH, STEP, LEAST = 24, 3, 0.3, 1.0


@dataclass
class Node:
    """A leaf (feature None) or a split: ``feature <= at`` goes left."""

    value: float = 0.0
    feature: str | None = None
    at: int = 0
    left: Node | None = None
    right: Node | None = None

    def sql(self, prefix: str) -> str:
        if self.feature is None:
            return f"{self.value:.6f}D"
        return f"IF({prefix}{self.feature} <= {self.at}, {self.left.sql(prefix)}, {self.right.sql(prefix)})"

    def of(self, row: dict) -> float:
        if self.feature is None:
            return round(self.value, 6)
        return (self.left if row[self.feature] <= self.at else self.right).of(row)


class Boosted:
    """Log-odds as a sum of trees."""

    def __init__(self, base: float, trees: list[Node]) -> None:
        self.base, self.trees = round(base, 6), trees

    def sql(self, prefix: str) -> str:
        """The log-odds of the feature struct that ``prefix`` names, as SQL."""
        return " + ".join([f"{self.base:.6f}D", *(t.sql(prefix) for t in self.trees)])

    def of(self, row: dict) -> float:
        return self.base + sum(t.of(row) for t in self.trees)


def _grow(x: np.ndarray, names: list[str], gradient: np.ndarray, hessian: np.ndarray, depth: int) -> Node:
    g, h = gradient.sum(), hessian.sum()
    best, split = 1e-9, None
    if depth:
        for c in range(x.shape[1]):
            order = np.argsort(x[:, c], kind="stable")
            v, gs, hs = x[order, c], np.cumsum(gradient[order]), np.cumsum(hessian[order])
            at = np.flatnonzero(v[1:] > v[:-1])
            left, right = hs[at], h - hs[at]
            gain = gs[at] ** 2 / (left + LEAST) + (g - gs[at]) ** 2 / (right + LEAST) - g * g / (h + LEAST)
            if len(gain) and gain.max() > best:
                k = int(gain.argmax())
                best, split = float(gain[k]), (c, int(v[at[k]]))
    if split is None:
        return Node(value=float(STEP * g / (h + LEAST)))
    low = x[:, split[0]] <= split[1]
    return Node(feature=names[split[0]], at=split[1], left=_grow(x[low], names, gradient[low], hessian[low], depth - 1),
                right=_grow(x[~low], names, gradient[~low], hessian[~low], depth - 1))


def fit(rows: list[dict], names: list[str]) -> Boosted:
    """Logistic loss over distinct feature vectors; ``rows`` have the integer
    features ``names`` and the weights ``yes`` and ``no``."""
    x = np.array([[r[n] for n in names] for r in rows], np.int64)
    yes, no = (np.array([r[k] for r in rows], float) for k in ("yes", "no"))
    base = math.log((yes.sum() + 1) / (no.sum() + 1))
    score, trees = np.full(len(rows), base), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        tree = _grow(x, names, yes - (yes + no) * p, (yes + no) * p * (1 - p), DEPTH)
        trees.append(tree)
        score = score + np.array([tree.of(r) for r in rows])
    return Boosted(base, trees)


def threshold(scores: list[float], yes: list[float], no: list[float], precision: float, least: float) -> float | None:
    """The lowest score from which on at least ``precision`` of the held-out weight
    is positive (one false positive added), with ``least`` positive weight above
    it; None if there is no such score."""
    out, good, bad = None, 0.0, 1.0
    for score in sorted(set(scores), reverse=True):
        good += sum(y for s, y in zip(scores, yes) if s == score)
        bad += sum(n for s, n in zip(scores, no) if s == score)
        if good >= least and good >= precision * (good + bad):
            out = score
    return out
