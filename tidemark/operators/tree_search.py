"""Random search over boosted trees with leaf penalties, all draws and folds grown together.

Trees split on histograms: a task adds up gradient and curvature of its rows per (problem, node, feature,
bin) and sends one array; the sums are added in Spark and the driver picks every open node's best
split. One pass grows one level of the current tree of every problem, so a search costs trees times
depth passes, however many draws and folds take part.

Value of a leaf: -soft(G) / (H + reg_lambda) times the learning rate, soft() moving G towards 0 by
reg_alpha; gain of a split: soft(G)^2 / (H + reg_lambda) of both sides less that of the node, which must be
above 0 and at least gamma; H of either side is at least min_child_weight. Margins begin at 0.
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.order_stats import auc, exact_quantiles, unpivot
from tidemark.operators.sums import parts_of, summed
from tidemark.session import stored

# Cuts per feature, and the bin of a missing value.
CUTS = 31
MISSING = CUTS + 1
BINS = MISSING + 1
# Trees after which the margins of all rows are written, so that a pass evaluates few trees anew.
WRITTEN_EVERY = 10
LEAST_GAIN = 1e-6
ALL = -1
ROWS = "label int, fold int, hash double, bins binary, margins binary"


@dataclass(frozen=True)
class Problem:
    """Parameters of a draw, the fold that is left out and the draw's number, which seeds its samples."""

    params: Mapping
    fold: int = ALL
    number: int = 0

    def columns(self, tree: int, n: int) -> list[int]:
        """The features that a tree may split on."""
        k = max(1, int(self.params["colsample_bytree"] * n + 1e-9))
        return sorted(random.Random(f"columns {self.number} {tree}").sample(range(n), k))

    def turn(self, tree: int) -> float:
        """A row takes part in a tree when its hash, turned by this, lies below the share of rows."""
        return random.Random(f"rows {self.number} {tree}").randrange(1 << 20) / (1 << 20)


@dataclass
class Forest:
    """Trees of all problems as arrays over (problem, tree, node); children of node i are 2i + 1 and 2i + 2.

    feature is -1 in a leaf. A row goes left when its bin is below `bin`, a missing value as `left` says.
    """

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, problems: int, trees: int, depth: int) -> Forest:
        shape = (problems, trees, 2 ** (depth + 1) - 1)
        return cls(
            np.full(shape, -1, np.int16), np.zeros(shape, np.int16), np.zeros(shape, bool), np.zeros(shape), np.zeros(shape)
        )

    def nodes(self, bins: np.ndarray, tree: int, levels: int) -> np.ndarray:
        """Node of every row in a tree of every problem after some levels; a row stays in a leaf."""
        problems = np.arange(len(self.feature))
        node = np.zeros((len(bins), len(problems)), np.int64)
        row = np.arange(len(bins))[:, None]
        for _ in range(levels):
            feature = self.feature[problems, tree, node]
            b = bins[row, np.maximum(feature, 0)]
            left = np.where(b == MISSING, self.left[problems, tree, node], b < self.bin[problems, tree, node])
            node = np.where(feature < 0, node, 2 * node + np.where(left, 1, 2))
        return node

    def margins(self, bins: np.ndarray, trees: range) -> np.ndarray:
        """Sum of the trees' values per row and problem."""
        problems, depth = np.arange(len(self.feature)), (self.feature.shape[2] + 1).bit_length() - 2
        total = np.zeros((len(bins), len(problems)))
        for t in trees:
            total += self.value[problems, t, self.nodes(bins, t, depth)]
        return total


def find_cuts(rows: DataFrame, features: Sequence[str]) -> list[list[float]]:
    """Up to CUTS different values per feature at even shares of its known values."""
    known = unpivot(rows.select(*[F.col(c).cast("double").alias(c) for c in features]), list(features), [])
    shares = [(i + 1) / (CUTS + 1) for i in range(CUTS)]
    found = exact_quantiles(known.where("value is not null"), "value", shares, ["feature"], interpolate=False)
    by = {r["feature"]: sorted(set(r["quantiles"])) for r in found.collect()}
    return [by.get(c, []) for c in features]


def binned(rows: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]]) -> DataFrame:
    """ROWS of (label, fold, hash, features): per feature the number of cuts up to the value, MISSING for NULL."""
    edges = [np.array(c, np.float64) for c in cuts]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.empty((batch.num_rows, len(edges)), np.uint8)
            for j, edge in enumerate(edges):
                v = batch.column(3 + j)
                x = np.asarray(v.fill_null(np.nan), np.float64)
                bins[:, j] = np.where(np.isnan(x), MISSING, np.searchsorted(edge, x, side="right"))
            data = pa.array([b.tobytes() for b in bins], pa.binary())
            empty = pa.array([b""] * batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), data, empty], names=["label", "fold", "hash", "bins", "margins"]
            )

    xs = [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]
    slim = rows.select(F.col("label").cast("int").alias("label"), F.col("fold").cast("int").alias("fold"), "hash", *xs)
    return slim.mapInArrow(run, ROWS)


def _arrays(batch: pa.RecordBatch, n: int, problems: int):
    y, fold, h = (np.asarray(batch.column(i), np.float64) for i in range(3))
    bins = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(len(y), n).astype(np.int64)
    before = b"".join(batch.column(4).to_pylist())
    margins = np.frombuffer(before, np.float64).reshape(len(y), problems) if before else np.zeros((len(y), problems))
    return y, fold, h, bins, margins


class Search:
    """Problems over the same stored ROWS."""

    def __init__(self, rows: DataFrame, n_features: int, problems: Sequence[Problem]):
        self.rows, self.n, self.problems = rows, n_features, list(problems)
        self.parts = max(1, parts_of(rows))

        def values(name: str, kind=np.float64) -> np.ndarray:
            return np.array([p.params[name] for p in self.problems], kind)

        self.trees, self.depth = values("n_estimators", np.int64), values("max_depth", np.int64)
        self.rate, self.share = values("learning_rate"), values("subsample")
        self.gamma, self.child = values("gamma"), values("min_child_weight")
        self.alpha, self.reg = values("reg_alpha"), values("reg_lambda")
        self.folds = np.array([p.fold for p in self.problems], np.float64)
        self.forest = Forest.empty(len(self.problems), int(self.trees.max()), int(self.depth.max()))
        self.written = 0

    def histograms(self, tree: int, level: int) -> np.ndarray:
        """G and H per (problem, node of the level, feature, bin) of the rows that take part in the tree."""
        n, forest, written, n_nodes = self.n, self.forest, self.written, 2**level
        turns, share, folds = np.array([p.turn(tree) for p in self.problems]), self.share, self.folds
        on = np.flatnonzero((self.trees > tree) & (self.depth > level))
        shape = (len(on), n_nodes * n * BINS)

        def work(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            total = np.zeros((2, *shape))
            for batch in batches:
                for a in range(0, batch.num_rows, 2048):
                    y, fold, h, bins, margins = _arrays(batch.slice(a, 2048), n, len(folds))
                    margins = margins + forest.margins(bins, range(written, tree))
                    p = 1.0 / (1.0 + np.exp(-margins))
                    turned = h[:, None] + turns
                    used = (fold[:, None] != folds) & (turned - np.floor(turned) < share)
                    node = forest.nodes(bins, tree, level) - (n_nodes - 1)
                    used &= node >= 0
                    place = np.arange(n) * BINS + bins
                    for k, m in enumerate(on.tolist()):
                        r = np.flatnonzero(used[:, m])
                        at = (node[r, m][:, None] * (n * BINS) + place[r]).ravel()
                        for s, v in enumerate((p[r, m] - y[r], p[r, m] * (1 - p[r, m]))):
                            total[s, k] += np.bincount(at, np.repeat(v, n), shape[1])
            return total.ravel()

        total = summed(self.rows, work, 2 * int(np.prod(shape)), self.parts).reshape(2, len(on), n_nodes, n, BINS)
        full = np.zeros((2, len(self.problems), n_nodes, n, BINS))
        full[:, on] = total
        return full

    def _soft(self, g: np.ndarray) -> np.ndarray:
        alpha = self.alpha.reshape(-1, *[1] * (g.ndim - 1))
        return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)

    def _worth(self, g: np.ndarray, h: np.ndarray) -> np.ndarray:
        reg = self.reg.reshape(-1, *[1] * (g.ndim - 1))
        return self._soft(g) ** 2 / (h + reg)

    def grow(self, tree: int, level: int) -> None:
        """Split the nodes of a level, and give values to their children."""
        G, H = self.histograms(tree, level)
        f, n_nodes = self.forest, 2**level
        allowed = np.zeros((len(self.problems), self.n), bool)
        for m, p in enumerate(self.problems):
            allowed[m, p.columns(tree, self.n)] = True
        whole_g, whole_h = G[:, :, 0].sum(-1), H[:, :, 0].sum(-1)
        # sums left of every cut; left of the last lie all known values
        below_g, below_h = G[..., :MISSING].cumsum(-1), H[..., :MISSING].cumsum(-1)
        # missing values right, then left: (problem, node, feature, cut, side)
        left_g = np.stack((below_g, below_g + G[..., MISSING:]), -1)
        left_h = np.stack((below_h, below_h + H[..., MISSING:]), -1)
        right_g, right_h = whole_g[..., None, None, None] - left_g, whole_h[..., None, None, None] - left_h
        gain = self._worth(left_g, left_h) + self._worth(right_g, right_h) - self._worth(whole_g, whole_h)[..., None, None, None]
        child = self.child.reshape(-1, 1, 1, 1, 1)
        gain[~((left_h >= child) & (right_h >= child) & allowed[:, None, :, None, None])] = -np.inf
        flat = gain.reshape(len(self.problems), n_nodes, -1)
        best = flat.argmax(-1)
        most = np.take_along_axis(flat, best[..., None], -1)[..., 0]
        feature, cut, side = np.unravel_index(best, gain.shape[2:])
        active = ((self.trees > tree) & (self.depth > level))[:, None]
        first = n_nodes - 1
        if level == 0:
            f.value[:, tree, 0] = np.where(self.trees > tree, -self._soft(whole_g[:, 0]) / (whole_h[:, 0] + self.reg) * self.rate, 0)
            reached = np.ones((len(self.problems), 1), bool)
        else:
            parents = (np.arange(first, first + n_nodes) - 1) // 2
            reached = f.feature[:, tree, parents] >= 0
        split = active & reached & (most > LEAST_GAIN) & (most >= self.gamma[:, None])
        m, k = np.nonzero(split)
        at = first + k
        f.feature[m, tree, at], f.bin[m, tree, at] = feature[m, k], cut[m, k] + 1
        f.left[m, tree, at], f.gain[m, tree, at] = side[m, k] == 1, most[m, k]
        place = (m, k, feature[m, k], cut[m, k], side[m, k])
        for child_at, g, h in ((2 * at + 1, left_g[place], left_h[place]), (2 * at + 2, right_g[place], right_h[place])):
            soft = np.sign(g) * np.maximum(np.abs(g) - self.alpha[m], 0)
            f.value[m, tree, child_at] = -soft / (h + self.reg[m]) * self.rate[m]

    def write_margins(self, tree: int) -> None:
        """Store the rows with the margins of all trees before `tree`."""
        n, forest, written, problems = self.n, self.forest, self.written, len(self.problems)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 2048):
                    part = batch.slice(a, 2048)
                    *_, bins, margins = _arrays(part, n, problems)
                    margins = margins + forest.margins(bins, range(written, tree))
                    data = pa.array([m.tobytes() for m in margins], pa.binary())
                    yield pa.RecordBatch.from_arrays([*part.columns[:4], data], names=part.schema.names)

        self.rows, self.written = stored(self.rows.mapInArrow(run, ROWS), "margins"), tree

    def fit(self) -> Forest:
        for tree in range(int(self.trees.max())):
            if tree - self.written >= WRITTEN_EVERY:
                self.write_margins(tree)
            for level in range(int(self.depth[self.trees > tree].max())):
                self.grow(tree, level)
        return self.forest

    def scores(self) -> DataFrame:
        """(problem, label, score): every row of a problem's left-out fold with its margin."""
        n, forest, written, folds = self.n, self.forest, self.written, self.folds
        trees = range(written, forest.feature.shape[1])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for a in range(0, batch.num_rows, 2048):
                    y, fold, _, bins, margins = _arrays(batch.slice(a, 2048), n, len(folds))
                    margins = margins + forest.margins(bins, trees)
                    row, problem = np.nonzero(fold[:, None] == folds)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(problem.astype(np.int32)), pa.array(y[row].astype(np.int32)), pa.array(margins[row, problem])],
                        names=["problem", "label", "score"],
                    )

        return self.rows.mapInArrow(run, "problem int, label int, score double")


def cut_value(cuts: Sequence[float], b: int) -> float:
    """The value below which rows of a bin under `b` lie; all known values when there are fewer cuts."""
    return float(cuts[b - 1]) if b <= len(cuts) else float("inf")


@dataclass(frozen=True)
class TreeModel:
    """Boosted trees over raw features: per tree a list of nodes (feature or None, cut, missing left, value)."""

    features: tuple[str, ...]
    trees: tuple

    @classmethod
    def of(cls, features: Sequence[str], cuts: Sequence[Sequence[float]], forest: Forest, problem: int, n_trees: int) -> TreeModel:
        def nodes(t: int) -> tuple:
            return tuple(
                (int(j), cut_value(cuts[j], b), bool(left), float(v)) if j >= 0 else (None, None, None, float(v))
                for j, b, left, v in zip(*(x[problem, t].tolist() for x in (forest.feature, forest.bin, forest.left, forest.value)), strict=True)
            )

        return cls(tuple(features), tuple(nodes(t) for t in range(n_trees)))

    def as_json(self) -> str:
        return json.dumps({"kind": "trees", "trees": self.trees})

    def probability(self) -> Column:
        """Sum of the trees as nested conditions, through the logistic function."""

        def at(tree: tuple, i: int) -> Column:
            j, cut, missing_left, value = tree[i]
            if j is None:
                return F.lit(value)
            x = F.nanvl(F.col(self.features[j]).cast("double"), F.lit(None).cast("double"))
            left = F.coalesce(x < F.lit(cut), F.lit(missing_left))
            return F.when(left, at(tree, 2 * i + 1)).otherwise(at(tree, 2 * i + 2))

        margin = sum((at(t, 0) for t in self.trees), F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


@dataclass(frozen=True)
class Result:
    draws: list[dict]
    aucs: list[float | None]
    best: int
    model: TreeModel


def fold_problems(draws: Sequence[Mapping], folds: int) -> list[Problem]:
    """Every draw without each fold, then on all rows."""
    return [Problem(d, f, i) for i, d in enumerate(draws) for f in (*range(folds), ALL)]


def prepared(rows: DataFrame, features: Sequence[str]) -> tuple[DataFrame, list[list[float]]]:
    """Stored ROWS of (label, fold, hash, features with NULL), and the cuts."""
    cuts = find_cuts(rows, features)
    return stored(binned(rows, features, cuts), "binned"), cuts


def search(rows: DataFrame, features: Sequence[str], draws: Sequence[Mapping], folds: int) -> Result:
    """Cross-validated search over stored rows (label, fold from 0, hash in [0, 1), features).

    A fold whose AUC is undefined, having one class, does not count. Of equal draws the first wins. All
    draws are grown on all rows as well, in the same passes, and the winner's trees are the model.
    """
    ready, cuts = prepared(rows, features)
    problems = fold_problems(draws, folds)
    grown = Search(ready, len(features), problems)
    forest = grown.fit()
    found = {r["problem"]: r["auc"] for r in auc(grown.scores(), "score", "label", ["problem"]).collect()}
    means = []
    for i in range(len(draws)):
        known = [a for f in range(folds) if (a := found.get(i * (folds + 1) + f)) is not None]
        means.append(sum(known) / len(known) if known else None)
    best = max(range(len(draws)), key=lambda i: (-1.0 if means[i] is None else means[i], -i))
    model = TreeModel.of(features, cuts, forest, best * (folds + 1) + folds, int(draws[best]["n_estimators"]))
    return Result([dict(d) for d in draws], means, best, model)


def tree_rows(problems: Sequence[Problem], forest: Forest, tree: int, features: Sequence[str], cuts: Sequence[Sequence[float]]) -> list[tuple]:
    """(draw, fold, node, feature, cut, gain, value) of the nodes of one tree of every problem that rows can
    reach; the first three numbers of a leaf are None, a cut beyond all values too."""
    found = []
    for m, p in enumerate(problems):
        todo = [0]
        while todo:
            i = todo.pop()
            j, value = int(forest.feature[m, tree, i]), float(forest.value[m, tree, i])
            if j < 0:
                found.append((p.number, p.fold, i, None, None, None, value))
                continue
            cut = cut_value(cuts[j], int(forest.bin[m, tree, i]))
            known = None if cut == float("inf") else cut
            found.append((p.number, p.fold, i, features[j], known, float(forest.gain[m, tree, i]), value))
            todo += [2 * i + 1, 2 * i + 2]
    return found
