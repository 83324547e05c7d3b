"""Gradient-boosted trees for two classes, fitted on a bounded sample and scored as Spark expressions.

fit() works on the driver, on at most as many rows as the caller's documented
bound. expression() turns the trees into nested CASE expressions, so scoring runs
over any number of rows inside Spark's generated code.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


@dataclass
class Node:
    value: float = 0.0
    feature: int = -1
    cut: float = 0.0
    low: Node | None = None
    high: Node | None = None


@dataclass
class Boosted:
    names: list[str]
    start: float = 0.0
    trees: list[Node] = field(default_factory=list)
    #: Calibration of the raw score on rows that the trees didn't see: sigmoid(a * raw + b).
    a: float = 1.0
    b: float = 0.0

    def raw(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        for t in self.trees:
            out += _leaf_values(t, x)
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.a * self.raw(x) + self.b)

    def expression(self, features: dict[str, Column]) -> Column:
        """The calibrated probability, from a column of each feature's name."""

        def of(n: Node) -> Column:
            return F.lit(float(n.value)) if n.low is None else F.when(features[self.names[n.feature]] <= F.lit(float(n.cut)), of(n.low)).otherwise(of(n.high))

        raw = F.lit(float(self.start))
        for t in self.trees:
            raw = raw + of(t)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-(raw * float(self.a) + float(self.b))))


def _leaf_values(n: Node, x: np.ndarray) -> np.ndarray:
    if n.low is None:
        return np.full(len(x), n.value)
    left = x[:, n.feature] <= n.cut
    out = np.empty(len(x))
    out[left] = _leaf_values(n.low, x[left])
    out[~left] = _leaf_values(n.high, x[~left])
    return out


def _grow(x, codes, cuts, g, h, depth, least, reg):
    value = -g.sum() / (h.sum() + reg)
    if depth == 0 or len(x) < 2 * least:
        return Node(value)
    best, total = (1e-6, -1, 0), g.sum() ** 2 / (h.sum() + reg)
    for f in range(x.shape[1]):
        if not len(cuts[f]):
            continue
        k = len(cuts[f]) + 1
        gs, hs, ns = (np.cumsum(np.bincount(codes[:, f], w, k))[:-1] for w in (g, h, np.ones(len(g))))
        ok = (ns >= least) & (len(g) - ns >= least)
        gain = np.where(ok, gs**2 / (hs + reg) + (g.sum() - gs) ** 2 / (h.sum() - hs + reg) - total, -1)
        at = int(gain.argmax())
        if gain[at] > best[0]:
            best = (gain[at], f, at)
    _, f, at = best
    if f < 0:
        return Node(value)
    left = codes[:, f] <= at
    kids = [_grow(x[m], codes[m], cuts, g[m], h[m], depth - 1, least, reg) for m in (left, ~left)]
    return Node(value, f, float(cuts[f][at]), *kids)


def fit(names: list[str], x: np.ndarray, y: np.ndarray, trees: int = 20, depth: int = 3, rate: float = 0.3, least: int = 8, reg: float = 1.0, bins: int = 32) -> Boosted:
    """Logistic loss, quantile bins, second-order leaves; a fifth of the rows calibrates. Same rows in, same trees out."""
    out = Boosted(list(names))
    x, y = np.asarray(x, float).reshape(-1, len(names)), np.asarray(y, float)
    if not len(y):
        return out
    held = np.random.default_rng(5).permutation(len(y)) % 5 == 4
    tx, ty = x[~held], y[~held]
    p = min(max(ty.mean(), 1e-3), 1 - 1e-3)
    out.start = float(np.log(p / (1 - p)))
    cuts = []
    for f in range(x.shape[1]):
        v = np.unique(tx[:, f])
        if len(v) > bins:
            v = np.unique(np.quantile(tx[:, f], np.linspace(0, 1, bins + 1)[1:-1]))
        cuts.append((v[1:] + v[:-1]) / 2 if len(v) > 1 else v[:0])
    codes = np.stack([np.searchsorted(c, tx[:, f], side="left") for f, c in enumerate(cuts)], 1) if len(tx) else np.zeros((0, x.shape[1]), int)
    score = np.full(len(ty), out.start)
    for _ in range(trees):
        q = _sigmoid(score)
        tree = _grow(tx, codes, cuts, q - ty, q * (1 - q), depth, least, reg)
        _shrink(tree, rate)
        out.trees.append(tree)
        score += _leaf_values(tree, tx)
    out.a, out.b = _calibrate(out.raw(x[held]), y[held])
    return out


def _shrink(n: Node, rate: float) -> None:
    n.value *= rate
    for k in (n.low, n.high):
        if k is not None:
            _shrink(k, rate)


def _calibrate(raw: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps for a logistic fit of y on raw, with a prior at (1, 0)."""
    a, b = 1.0, 0.0
    if len(y) < 20 or y.min() == y.max():
        return a, b
    for _ in range(25):
        p = _sigmoid(a * raw + b)
        w = p * (1 - p)
        grad = np.array([((p - y) * raw).sum() + (a - 1), (p - y).sum() + b])
        hess = np.array([[(w * raw * raw).sum() + 1, (w * raw).sum()], [(w * raw).sum(), w.sum() + 1]])
        step = np.clip(np.linalg.solve(hess, grad), -0.5, 0.5)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-8:
            break
    return float(a), float(b)


def threshold_for(probability: np.ndarray, y: np.ndarray, precision: float) -> float:
    """The least threshold at which the rows above it reach the precision; above every row if none does."""
    order = np.argsort(-probability, kind="stable")
    hits = np.cumsum(y[order]) / np.arange(1, len(y) + 1)
    ok = np.flatnonzero(hits >= precision)
    return float(probability[order][ok[-1]]) if len(ok) else 1.1
