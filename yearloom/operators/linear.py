"""Ridge regression from sums: two aggregates whatever the number of rows, one small solve."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Linear:
    """An intercept and one coefficient per feature."""

    intercept: float
    coefficients: tuple[float, ...]

    def column(self, features: Sequence[str]) -> Column:
        """The prediction as a plain expression."""
        total = F.lit(self.intercept)
        for weight, name in zip(self.coefficients, features, strict=True):
            total = total + F.lit(weight) * F.col(name)
        return total


@dataclass(frozen=True)
class Moments:
    """Rows without a missing value, and the columns' means over them."""

    rows: DataFrame
    count: int
    means: dict[str, float]


def moments(train: DataFrame, columns: Sequence[str]) -> Moments:
    values = train.select(*[F.col(c).cast("double").alias(c) for c in columns])
    rows = values.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))
    count, *means = rows.agg(F.count("*"), *[F.avg(c) for c in columns]).first()
    return Moments(rows, count, dict(zip(columns, means, strict=True)))


def gram(found: Moments) -> DataFrame:
    """Mean products of the centred columns, one row per pair: left_col, right_col, cross_product.

    Each value is centred before it is multiplied, so large means cost no digits.
    """
    columns = list(found.means)
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    centred = found.rows.select(*[(F.col(c) - F.lit(m)).alias(c) for c, m in found.means.items()])
    sums = centred.agg(*[F.sum(F.col(a) * F.col(b)).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("left_col"), F.lit(b).alias("right_col"), (F.col(f"c{i}") / found.count).alias("cross_product"))
        for i, (a, b) in enumerate(pairs)
    ])))


def solve(products: np.ndarray, targets: np.ndarray, penalty: float) -> np.ndarray:
    """The w with ``(products + penalty) w = targets``, one column a target.

    Rows and columns are scaled to a diagonal of ones first: features differ by many orders
    of magnitude.  Without a penalty, features that depend on others share their weight.
    """
    diagonal = np.diag(products) + penalty
    scale = 1 / np.sqrt(np.where(diagonal > 0, diagonal, 1.0))
    matrix = products * np.outer(scale, scale) + np.diag(penalty * scale * scale)
    try:
        found = np.linalg.solve(matrix, scale[:, None] * targets)
    except np.linalg.LinAlgError:
        found = np.linalg.lstsq(matrix, scale[:, None] * targets, rcond=None)[0]
    return scale[:, None] * found


def ridge(train: DataFrame, features: Sequence[str], labels: Sequence[str], alpha: float) -> list[Linear]:
    """Least squares plus ``alpha * |w|^2`` on unscaled features with a free intercept, all labels at once.

    Rows with a missing feature or label take no part; without any row there is no model.
    """
    found = moments(train, [*features, *labels])
    if not found.count:
        raise ValueError("no rows to fit")
    place = {c: i for i, c in enumerate(found.means)}
    sums = np.zeros((len(place), len(place)))
    for left, right, product in gram(found).collect():
        sums[place[left], place[right]] = sums[place[right], place[left]] = product * found.count
    n = len(features)
    weights = solve(sums[:n, :n], sums[:n, n:], alpha)
    centre = np.array([found.means[c] for c in features])
    return [Linear(float(found.means[label] - centre @ w), tuple(float(v) for v in w)) for label, w in zip(labels, weights.T, strict=True)]


def residuals(train: DataFrame, models: dict[str, tuple[str, Linear]], features: Sequence[str], alpha: float) -> DataFrame:
    """What is left of the normal equations, per model (label, fit) and feature, as a share of their sizes.

    The rest of feature x is the sum of (x - mean)(y - prediction) less ``alpha`` times its
    weight; its size is the same sum of absolute values.  At the solution both shares and
    the mean error are 0 but for rounding.
    """
    found = moments(train, [*features, *{label for label, _ in models.values()}])
    parts = {
        (name, i): ((F.col(c) - F.lit(found.means[c])) * (F.col(label) - model.column(features)))
        for name, (label, model) in models.items() for i, c in enumerate(features)
    }
    sums = found.rows.agg(
        *[F.sum(v).alias(f"s_{name}_{i}") for (name, i), v in parts.items()],
        *[F.sum(F.abs(v)).alias(f"a_{name}_{i}") for (name, i), v in parts.items()])
    rows = F.array(*[
        F.struct(F.lit(name).alias("model"), F.lit(features[i]).alias("feature"),
                 F.coalesce(F.try_divide(F.col(f"s_{name}_{i}") - F.lit(alpha * models[name][1].coefficients[i]),
                                         F.col(f"a_{name}_{i}")), F.lit(0.0)).alias("rest"))
        for name, i in parts
    ])
    return sums.select(F.inline(rows))
