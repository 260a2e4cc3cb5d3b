"""Logistic regression by iteratively reweighted least squares, for tables of few numbers.

Each step is one grouped aggregate: every task adds up its rows' share of the loss, the gradient and the matrix of second
derivatives, one row per cell is summed, and the driver solves a system of as many unknowns as there are numbers. The
steps converge quadratically, so the answer is the optimum itself and not where an iteration limit stopped.
Cells grow with the square of the numbers; for wide vectors take ``operators.model``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class LogisticFit:
    columns: tuple[str, ...]
    intercept: float
    coefficients: tuple[float, ...]
    steps: int
    converged: bool
    loss: float

    def probability(self) -> Column:
        """Of class 1, from the columns."""
        score = F.lit(self.intercept)
        for name, w in zip(self.columns, self.coefficients):
            score = score + F.col(name) * F.lit(w)
        return 1 / (1 + F.exp(-score))


def _sums(rows: DataFrame, w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Weighted loss, its gradient and second derivatives at ``w``; columns are label, weight, numbers."""
    size = len(w)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size + 1, size + 1))
        for batch in batches:
            y, c, *x = (np.asarray(col, float) for col in batch.columns)
            x = np.stack([np.ones(len(y)), *x], 1)
            z = x @ w
            p = 0.5 * (1 + np.tanh(z / 2))
            total[0, 0] += (c * (np.logaddexp(0, z) - y * z)).sum()
            total[0, 1:] += (c * (p - y)) @ x
            total[1:, 1:] += (x * (c * p * (1 - p))[:, None]).T @ x
        i, j = np.triu_indices(size + 1)
        yield pa.record_batch({"i": pa.array(i, pa.int32()), "j": pa.array(j, pa.int32()), "v": pa.array(total[i, j])})

    cells = rows.mapInArrow(partial, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((size + 1, size + 1))
    for r in cells:
        out[r["i"], r["j"]] = out[r["j"], r["i"]] = r["v"]
    return out[0, 0], out[0, 1:], out[1:, 1:]


def class_weights(rows: DataFrame, label: str) -> dict[int, float]:
    """Weights that make both classes count alike; they add up to the number of rows."""
    classes = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    if set(classes) != {0, 1}:
        raise ValueError(f"training needs rows of both classes, got {sorted(classes, key=str)}")
    n = sum(classes.values())
    return {y: n / (2.0 * m) for y, m in classes.items()}


def fit_logistic(
    rows: DataFrame, columns: list[str], label: str, penalty: float = 1.0, max_iter: int = 1000,
    tolerance: float = 1e-10, balanced: bool = True,
) -> LogisticFit:
    """Minimise the weighted loss plus ``penalty / 2`` times the squared length of the coefficients.

    The intercept is free. ``rows`` are read once per step and should be staged; NULL numbers count as 0.
    """
    weights = class_weights(rows, label)
    weight = F.when(F.col(label) == 1, weights[1]).otherwise(weights[0]) if balanced else F.lit(1.0)
    narrow = rows.select(F.col(label).cast("double"), weight.alias("_weight"),
                         *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(f"_{k}") for k, c in enumerate(columns)])
    ridge = np.array([0.0] + [penalty] * len(columns))

    def at(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        loss, gradient, second = _sums(narrow, w)
        return loss + 0.5 * (ridge * w * w).sum(), gradient + ridge * w, second + np.diag(ridge)

    w = np.zeros(len(columns) + 1)
    loss, gradient, second = at(w)
    steps, converged = 0, False
    while steps < max_iter and not converged:
        steps += 1
        move = np.linalg.lstsq(second, gradient, rcond=None)[0]
        share = 1.0
        while True:  # a whole step may overshoot far from the optimum
            moved = at(w - share * move)
            if moved[0] <= loss + 1e-12 * abs(loss) or share < 1e-6:
                break
            share /= 2
        w, (loss, gradient, second) = w - share * move, moved
        converged = float(np.abs(share * move).max()) <= tolerance * max(1.0, float(np.abs(w).max()))
    return LogisticFit(tuple(columns), float(w[0]), tuple(map(float, w[1:])), steps, converged, float(loss))
