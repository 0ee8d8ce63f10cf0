"""Random search over penalised logistic regressions, all draws and folds fitted together.

A pass over the stored training rows gives loss, gradient and curvature of every open problem at once:
each task multiplies its rows with the matrix of all coefficients and sends one array of sums. The
driver holds the problems' coefficients only and takes a (proximal) Newton step for each of them, so a
search costs about ten passes instead of one solver run per draw and fold.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.order_stats import auc
from tidemark.operators.sums import parts_of, summed

# A problem is solved when its penalised gradient, divided by C, is below this share of its rows.
TOLERANCE = 1e-12
PASSES = 100
ALL = -1


@dataclass(frozen=True)
class Problem:
    """C times the weighted log-loss of the rows outside `fold` plus the penalty of all coefficients,
    the constant's included."""

    C: float
    l1: bool
    balanced: bool
    fold: int = ALL

    @classmethod
    def of(cls, draw: Mapping, fold: int = ALL) -> Problem:
        return cls(draw["C"], draw["penalty"] == "l1", draw["class_weight"] == "balanced", fold)


@dataclass(frozen=True)
class Scaling:
    """Mean and population deviation per feature; a constant one is centred only."""

    mean: np.ndarray
    spread: np.ndarray

    def raw(self, beta: np.ndarray) -> tuple[np.ndarray, float]:
        """Weights and constant for unscaled features."""
        weights = beta[:-1] / self.spread
        return weights, float(beta[-1] - (weights * self.mean).sum())


def scaling(rows: DataFrame, features: Sequence[str]) -> Scaling:
    found = rows.agg(
        *[F.avg(F.col(c).cast("double")).alias(f"m{i}") for i, c in enumerate(features)],
        *[F.stddev_pop(F.col(c).cast("double")).alias(f"s{i}") for i, c in enumerate(features)],
    ).first()
    values = np.array([np.nan if v is None else v for v in found], np.float64)
    mean, spread = np.nan_to_num(values[: len(features)]), np.nan_to_num(values[len(features) :])
    return Scaling(mean, np.where(spread == 0, 1.0, spread))


def scaled(rows: DataFrame, features: Sequence[str], by: Scaling) -> DataFrame:
    """label, fold and the scaled features as x0, x1, ..."""
    xs = [
        ((F.col(c).cast("double") - F.lit(float(m))) / F.lit(float(s))).alias(f"x{i}")
        for i, (c, m, s) in enumerate(zip(features, by.mean, by.spread, strict=True))
    ]
    return rows.select(F.col("label").cast("int").alias("label"), "fold", *xs)


def _matrix(batch: pa.RecordBatch, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Label, fold and the features with a column of ones at the end."""
    y, fold = (np.asarray(batch.column(i), np.float64) for i in (0, 1))
    x = np.ones((len(y), n + 1))
    for i in range(n):
        x[:, i] = np.asarray(batch.column(2 + i), np.float64)
    return y, fold, x


def _row_weights(y: np.ndarray, fold: np.ndarray, folds: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Weight of each row in each problem: its class's, or 0 in the fold that is left out."""
    weights = np.where(y[:, None] > 0.5, classes[:, 1], classes[:, 0])
    return np.where(fold[:, None] == folds, 0.0, weights)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    e = np.exp(-np.abs(z))
    return np.where(z >= 0, 1.0, e) / (1.0 + e)


class Search:
    """Problems over the same rows (label, fold, x0, x1, ... without NULL), which are read in every pass."""

    def __init__(self, rows: DataFrame, n_features: int, problems: Sequence[Problem]):
        self.rows, self.n, self.problems = rows, n_features, list(problems)
        self.parts = max(1, parts_of(rows))
        counts = {(r["fold"], r["label"]): r["n"] for r in rows.groupBy("fold", "label").agg(F.count("*").alias("n")).collect()}
        self.sizes = np.array([
            [sum(n for (f, y), n in counts.items() if f != p.fold and y == label) for label in (0, 1)] for p in self.problems
        ], np.float64).reshape(-1, 2)
        even = self.sizes.sum(1, keepdims=True) / (2 * np.maximum(self.sizes, 1))
        balanced = np.array([p.balanced for p in self.problems], bool)
        self.classes = np.where(balanced[:, None], even, 1.0)
        self.folds = np.array([p.fold for p in self.problems], np.float64)
        self.C = np.array([p.C for p in self.problems])
        self.l1 = np.array([p.l1 for p in self.problems], bool)

    def sums(self, beta: np.ndarray, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Loss, gradient and curvature of the open problems at `beta`, without penalties."""
        n, folds, classes = self.n, self.folds[open_], self.classes[open_]
        rows, cols = np.triu_indices(n + 1)
        width = 1 + (n + 1) + len(rows)

        def work(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            total = np.zeros((len(beta), width))
            for batch in batches:
                for a in range(0, batch.num_rows, 4096):
                    y, fold, x = _matrix(batch.slice(a, 4096), n)
                    w = _row_weights(y, fold, folds, classes)
                    z = x @ beta.T
                    p = _sigmoid(z)
                    total[:, 0] += (w * (np.logaddexp(0, z) - y[:, None] * z)).sum(0)
                    total[:, 1 : n + 2] += (w * (p - y[:, None])).T @ x
                    total[:, n + 2 :] += (w * p * (1 - p)).T @ (x[:, rows] * x[:, cols])
            return total.ravel()

        total = summed(self.rows, work, len(beta) * width, self.parts).reshape(len(beta), width)
        curvature = np.zeros((len(beta), n + 1, n + 1))
        curvature[:, rows, cols] = curvature[:, cols, rows] = total[:, n + 2 :]
        return total[:, 0], total[:, 1 : n + 2], curvature

    def moments(self, beta: np.ndarray) -> np.ndarray:
        """Per problem and feature: weighted sum of probability times feature, plus the penalty's gradient
        over C. At the minimum this equals the weighted sum of label times feature, which does not
        depend on the model. The gradient of |b| at 0 is the number of -1..1 that comes nearest."""
        n, folds, classes = self.n, self.folds, self.classes

        def work(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            total = np.zeros((2, len(beta), n + 1))
            for batch in batches:
                for a in range(0, batch.num_rows, 4096):
                    y, fold, x = _matrix(batch.slice(a, 4096), n)
                    w = _row_weights(y, fold, folds, classes)
                    total[0] += (w * _sigmoid(x @ beta.T)).T @ x
                    total[1] += (w * y[:, None]).T @ x
            return total.ravel()

        size = 2 * len(beta) * (n + 1)
        expected, seen = summed(self.rows, work, size, self.parts).reshape(2, len(beta), n + 1)
        at_zero = np.clip((seen - expected) * self.C[:, None], -1, 1)
        slope = np.where(self.l1[:, None], np.where(beta != 0, np.sign(beta), at_zero), beta)
        return expected + slope / self.C[:, None]

    def solve(self) -> np.ndarray:
        """Coefficients of every problem, the constant last."""
        beta = np.zeros((len(self.problems), self.n + 1))
        trial = beta.copy()
        step = np.zeros_like(beta)
        length, gain = np.ones(len(beta)), np.zeros(len(beta))
        value = np.full(len(beta), np.inf)
        open_ = np.arange(len(beta))
        for _ in range(PASSES):
            if not len(open_):
                return beta
            loss, gradient, curvature = self.sums(trial[open_], open_)
            solved = []
            for k, i in enumerate(open_.tolist()):
                C, l1 = self.C[i], self.l1[i]
                now = C * loss[k] + (np.abs(trial[i]).sum() if l1 else (trial[i] ** 2).sum() / 2)
                # a step must give a part of the decrease that the model of the loss promised
                enough = value[i] + 1e-4 * length[i] * gain[i] + 1e-13 * abs(now)
                if now > enough and length[i] > 1e-9:
                    length[i] /= 2
                    trial[i] = beta[i] + length[i] * step[i]
                    continue
                beta[i], value[i], length[i] = trial[i], now, 1.0
                g, H = C * gradient[k], C * curvature[k]
                if _violation(g, beta[i], l1) / C <= TOLERANCE * max(1.0, self.sizes[i].sum()):
                    solved.append(i)
                    continue
                if l1:
                    step[i] = _lasso_step(g, H, beta[i])
                    gain[i] = g @ step[i] + np.abs(beta[i] + step[i]).sum() - np.abs(beta[i]).sum()
                else:
                    step[i] = -np.linalg.solve(H + np.eye(len(g)), g + beta[i])
                    gain[i] = (g + beta[i]) @ step[i]
                trial[i] = beta[i] + step[i]
                if not gain[i] < 0 or np.abs(step[i]).max() <= 1e-15 * max(1.0, np.abs(beta[i]).max()):
                    solved.append(i)  # no further decrease that doubles can express
            open_ = np.setdiff1d(open_, solved)
        raise RuntimeError(f"{len(open_)} of {len(beta)} regressions did not settle")


def _violation(g: np.ndarray, b: np.ndarray, l1: bool) -> float:
    """Largest part of the penalised gradient that is not 0."""
    if not l1:
        return float(np.abs(g + b).max())
    return float(np.where(b != 0, np.abs(g + np.sign(b)), np.maximum(np.abs(g) - 1, 0)).max())


def _lasso_step(g: np.ndarray, H: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum of g d + d H d / 2 + |b + d| by coordinate descent, then exactly on its support."""
    z, slope = b.copy(), g.copy()  # slope: gradient of the smooth part at z
    diagonal, scale = np.maximum(np.diag(H), 1e-12), min(1.0, float(np.abs(g).max()))
    for _ in range(2000):
        most = 0.0
        for j in range(len(b)):
            to = z[j] - slope[j] / diagonal[j]
            to = np.sign(to) * max(abs(to) - 1 / diagonal[j], 0.0)
            if to != z[j]:
                most = max(most, abs(to - z[j]) * diagonal[j])
                slope += H[:, j] * (to - z[j])
                z[j] = to
        if most <= 1e-13 * scale:
            break
    on = np.flatnonzero(z)
    if len(on):
        sign = np.sign(z[on])
        # g + H (z - b) + sign = 0 on the support, z being 0 elsewhere
        exact = np.linalg.lstsq(H[np.ix_(on, on)], H[on] @ b - g[on] - sign, rcond=None)[0]
        if (np.sign(exact) == sign).all():
            z = np.zeros_like(b)
            z[on] = exact
    return z - b


def scores(rows: DataFrame, n: int, problems: Sequence[Problem], beta: np.ndarray) -> DataFrame:
    """(problem, label, score): every row of a problem's left-out fold with its score."""
    folds = np.array([p.fold for p in problems])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 4096):
                y, fold, x = _matrix(batch.slice(a, 4096), n)
                row, problem = np.nonzero(fold[:, None] == folds)
                z = (x @ beta.T)[row, problem]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(problem.astype(np.int32)), pa.array(y[row].astype(np.int32)), pa.array(z)],
                    names=["problem", "label", "score"],
                )

    return rows.mapInArrow(run, "problem int, label int, score double")


@dataclass(frozen=True)
class Result:
    """The draws with the mean AUC of their folds, and the best of them fitted to all rows."""

    draws: list[dict]
    aucs: list[float | None]
    best: int
    beta: np.ndarray
    scaling: Scaling


def fold_problems(draws: Sequence[Mapping], folds: int) -> list[Problem]:
    return [Problem.of(d, f) for d in draws for f in range(folds)]


def search(rows: DataFrame, features: Sequence[str], draws: Sequence[Mapping], folds: int) -> Result:
    """Cross-validated search over stored rows (label, fold from 0, features without NULL).

    Features are scaled on all rows. A fold whose AUC is undefined, having one class, does not count.
    Of equal draws the first wins.
    """
    by = scaling(rows, features)
    x = scaled(rows, features, by)
    problems = fold_problems(draws, folds)
    beta = Search(x, len(features), problems).solve()
    found = {r["problem"]: r["auc"] for r in auc(scores(x, len(features), problems, beta), "score", "label", ["problem"]).collect()}
    means = []
    for i in range(len(draws)):
        known = [a for f in range(folds) if (a := found.get(i * folds + f)) is not None]
        means.append(sum(known) / len(known) if known else None)
    best = max(range(len(draws)), key=lambda i: (-1.0 if means[i] is None else means[i], -i))
    final = Search(x, len(features), [Problem.of(draws[best])]).solve()[0]
    return Result([dict(d) for d in draws], means, best, final, by)
