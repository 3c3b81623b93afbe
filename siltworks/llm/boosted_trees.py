"""Gradient-boosted trees: trained with Spark ML on a bounded labelled sample, applied as a Column or with numpy.

A tree is a number (leaf) or (feature, threshold, left, right); values up to the threshold go left.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Tree = float | tuple

SPLIT = re.compile(r"\(feature (\d+) (<=|>) ([-+.\dE]+)\)")


def parse(lines: list[str]) -> list[Tree]:
    """The trees in Spark ML's text form of an ensemble."""
    trees, at = [], 0

    def node() -> Tree:
        nonlocal at
        line = lines[at]
        at += 1
        if "Predict:" in line:
            return float(line.split("Predict:")[1])
        feature, _, threshold = SPLIT.search(line).groups()
        left = node()
        at += 1  # Else
        return int(feature), float(threshold), left, node()

    while at < len(lines):
        if re.match(r"\s*Tree \d+ \(weight", lines[at]):
            at += 1
            trees.append(node())
        else:
            at += 1
    return trees


def fit(sample: DataFrame, features: str, label: str, rounds: int = 20, depth: int = 4) -> list[tuple[float, Tree]]:
    """Weights and trees; sample: a bounded number of rows with an array of doubles and a label 0 or 1. One class only: a constant."""
    mean, n = sample.agg(F.avg(label), F.count("*")).first()
    if not n or mean in (0.0, 1.0):
        return [(1.0, 0.0 if not n else 1.0 if mean else -1.0)]
    model = GBTClassifier(featuresCol="_x", labelCol="_y", maxIter=rounds, maxDepth=depth, seed=7, stepSize=0.2).fit(sample.select(array_to_vector(features).alias("_x"), F.col(label).cast("double").alias("_y")))
    return list(zip(model.treeWeights, parse(model.toDebugString.splitlines()), strict=True))


def margin(trees: list[tuple[float, Tree]], features: list[Column]) -> Column:
    """The ensemble's score as one expression; over 0 means label 1."""

    def value(tree: Tree) -> Column:
        if isinstance(tree, float):
            return F.lit(tree)
        feature, threshold, left, right = tree
        return F.when(features[feature] <= threshold, value(left)).otherwise(value(right))

    total = F.lit(0.0)
    for weight, tree in trees:
        total = total + weight * value(tree)
    return total


def margins(trees: list[tuple[float, Tree]], x: np.ndarray) -> np.ndarray:
    """The ensemble's scores of the rows of x."""
    total = np.zeros(len(x))

    def add(tree: Tree, rows: np.ndarray, weight: float) -> None:
        if isinstance(tree, float):
            total[rows] += weight * tree
            return
        feature, threshold, left, right = tree
        low = x[rows, feature] <= threshold
        add(left, rows[low], weight)
        add(right, rows[~low], weight)

    for weight, tree in trees:
        add(tree, np.arange(len(x)), weight)
    return total
