"""Gradient-boosted trees on a small labelled table, and the same trees as column expressions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, functions as F

# A tree is a leaf value, or (feature, cut, tree below the cut, tree from the cut on).


def _best_split(rows, residuals, weights, members, least):
    total_r, total_w = sum(residuals[i] for i in members), sum(weights[i] for i in members)
    best = (1e-9, None, None)
    for f in range(len(rows[0])):
        order = sorted(members, key=lambda i: rows[i][f])
        r = w = 0.0
        for n, (i, j) in enumerate(zip(order, order[1:]), 1):
            r, w = r + residuals[i], w + weights[i]
            if rows[i][f] == rows[j][f] or n < least or len(order) - n < least:
                continue
            gain = r * r / (w + 1) + (total_r - r) ** 2 / (total_w - w + 1) - total_r ** 2 / (total_w + 1)
            if gain > best[0]:
                best = (gain, f, (rows[i][f] + rows[j][f]) / 2)
    return best


def _grow(rows, residuals, weights, members, depth, least):
    _, feature, cut = _best_split(rows, residuals, weights, members, least) if depth else (0, None, None)
    if feature is None:
        return sum(residuals[i] for i in members) / (sum(weights[i] for i in members) + 1)
    below = [i for i in members if rows[i][feature] < cut]
    above = [i for i in members if rows[i][feature] >= cut]
    return feature, cut, _grow(rows, residuals, weights, below, depth - 1, least), _grow(rows, residuals, weights, above, depth - 1, least)


def value_of(tree, row) -> float:
    while isinstance(tree, tuple):
        feature, cut, below, above = tree
        tree = below if row[feature] < cut else above
    return tree


def boost(rows: Sequence[Sequence[float]], labels: Sequence[int], rounds: int = 40, depth: int = 3, rate: float = 0.3,
          least: int = 2) -> list:
    """Trees whose sum is the log-odds of label 1 (second-order boosting of the logistic loss)."""
    trees, margins = [], [0.0] * len(rows)
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        tree = _grow(rows, [y - q for y, q in zip(labels, p, strict=True)], [q * (1 - q) for q in p], range(len(rows)), depth, least)
        tree = _scaled(tree, rate)
        trees.append(tree)
        margins = [m + value_of(tree, row) for m, row in zip(margins, rows, strict=True)]
    return trees


def _scaled(tree, rate):
    return (tree[0], tree[1], _scaled(tree[2], rate), _scaled(tree[3], rate)) if isinstance(tree, tuple) else tree * rate


def calibrated_threshold(rows, labels, precision: float, folds: int = 4) -> float:
    """Least probability from which held-out rows reach ``precision`` (each fold scored by trees of the others)."""
    scored = []
    for fold in range(folds):
        inside = [i for i in range(len(rows)) if i % folds != fold]
        trees = boost([rows[i] for i in inside], [labels[i] for i in inside])
        scored += [(1 / (1 + math.exp(-sum(value_of(t, rows[i]) for t in trees))), labels[i]) for i in range(fold, len(rows), folds)]
    scored.sort(reverse=True)
    good, threshold = 0, 0.5
    for n, (p, label) in enumerate(scored, 1):
        good += label
        if good / n >= precision:
            threshold = p
    return min(max(threshold, 0.5), 0.95)


def margin(trees: Sequence, features: Sequence[Column]) -> Column:
    """The sum of the trees over feature columns."""
    def column(tree):
        if not isinstance(tree, tuple):
            return F.lit(float(tree))
        feature, cut, below, above = tree
        return F.when(features[feature] < F.lit(float(cut)), column(below)).otherwise(column(above))

    total = F.lit(0.0)
    for tree in trees:
        total = total + column(tree)
    return total
