"""Model training by random search, scoring and the model registry."""

from __future__ import annotations

import datetime as dt
import itertools
import json
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.dates import split_dates
from tidemark.operators import linear_search, tree_search
from tidemark.operators.dataset import hash_fraction
from tidemark.operators.metrics import auc_gini
from tidemark.operators.tree_search import TreeModel
from tidemark.operators.typing import drop_if_all_null, fill_nulls
from tidemark.rules import TrainingWindow
from tidemark.session import stored

# Search spaces and budgets.
LR_SPACE = {
    "C": [10 ** (-3 + 5 * i / 11) for i in range(12)],
    "penalty": ["l1", "l2"],
    "class_weight": ["none", "balanced"],
}
LR_DRAWS = 40
GBT_SPACE = {
    "n_estimators": [25, 50],
    "max_depth": [2, 3],
    "learning_rate": [0.01, 0.1],
    "subsample": [0.6, 0.8],
    "colsample_bytree": [0.6, 0.8],
    "gamma": [0, 0.1],
    "min_child_weight": [1, 3, 5],
    "reg_alpha": [0, 0.1, 1],
    "reg_lambda": [1, 1.5, 2],
}
GBT_DRAWS = 100
FOLDS = 3
SEARCH_SEED = 42


@dataclass(frozen=True)
class LinearModel:
    """A logistic model given by its weights; a missing feature, NULL or NaN, counts as 0."""

    features: tuple[str, ...]
    weights: tuple[float, ...]
    intercept: float = 0.0

    def as_json(self) -> str:
        return json.dumps({"kind": "linear", "weights": self.weights, "intercept": self.intercept})

    def probability(self) -> Column:
        terms = (
            F.lit(w) * F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double")), F.lit(0.0))
            for f, w in zip(self.features, self.weights, strict=True)
        )
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-sum(terms, F.lit(self.intercept))))


@dataclass(frozen=True)
class TrainedModel:
    family: str
    train_date: dt.date
    features: tuple[str, ...]
    fitted: LinearModel | TreeModel
    params: Mapping[str, object]
    cv_auc: float | None = None

    @property
    def name(self) -> str:
        return f"{self.family}_{self.train_date:%Y_%m_%d}"


def draw_params(space: Mapping[str, Sequence], n_draws: int, seed: int = SEARCH_SEED) -> list[dict]:
    """Random search without repetition over a discrete grid."""
    grid = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    return random.Random(seed).sample(grid, min(n_draws, len(grid)))


def prepare(family: str, data: DataFrame, features: Sequence[str]) -> DataFrame:
    """Feature columns as doubles; the linear model counts a missing one as 0, trees place it by themselves."""
    numbers = data.withColumns({c: F.col(c).cast("double") for c in features})
    return fill_nulls(numbers, features, 0.0) if family == "model_lr" else numbers


def train(
    family: str,
    split: DataFrame,
    features: Sequence[str],
    train_date: dt.date,
    n_draws: int | None = None,
    folds: int = FOLDS,
    keys: Sequence[str] = ("Customer_ID", "snapshot_date"),
) -> TrainedModel:
    """Random search with cross-validated AUC on the train split, refit on all of it.

    The prepared rows are stored once: every pass or fit reads them, and a lost executor must not
    recompute the feature joins.
    """
    chosen = split.where(F.col("split") == "train")
    rows = training_rows(family, chosen, features, keys, folds)
    if family == "model_lr":
        draws = draw_params(LR_SPACE, n_draws or LR_DRAWS)
        found = linear_search.search(rows, features, draws, folds)
        weights, intercept = found.scaling.raw(found.beta)
        fitted = LinearModel(tuple(features), tuple(map(float, weights)), intercept)
    elif family == "model_gbt":
        draws = draw_params(GBT_SPACE, n_draws or GBT_DRAWS)
        found = tree_search.search(rows, features, draws, folds)
        fitted = found.model
    else:
        raise ValueError(f"unknown model family: {family}")
    return TrainedModel(family, train_date, tuple(features), fitted, draws[found.best], found.aucs[found.best])


def training_rows(
    family: str, chosen: DataFrame, features: Sequence[str], keys: Sequence[str], folds: int, seed: int = SEARCH_SEED
) -> DataFrame:
    """Stored rows (label, fold, hash, features); a key's fold and the hash for row samples come from its text."""
    fold = F.floor(hash_fraction(keys, seed) * folds).cast("int").alias("fold")
    sample = hash_fraction(keys, seed + 1).alias("hash")
    return stored(prepare(family, chosen, features).select("label", fold, sample, *features), "training")


def score(model: TrainedModel | LinearModel, rows: DataFrame, keep: Sequence[str]) -> DataFrame:
    """P(label = 1) as model_predictions next to the kept columns, as one expression."""
    fitted = model.fitted if isinstance(model, TrainedModel) else model
    return rows.select(*keep, fitted.probability().alias("model_predictions"))


def evaluate(model: TrainedModel, split: DataFrame) -> DataFrame:
    """Rows, exact AUC and Gini per split."""
    ranked = auc_gini(score(model, split, ["split", "label"]), ["split"])
    return ranked.select(
        F.lit(model.name).alias("model_name"),
        "split",
        (F.col("n_pos") + F.col("n_neg")).alias("n_rows"),
        F.round("auc", 3).alias("auc"),
        F.round("gini", 3).alias("gini"),
    )


def batch_score(
    model: TrainedModel | LinearModel,
    store: DataFrame,
    snapshot: dt.date,
    reference: Sequence[dt.date] = (),
    model_name: str = "prod_model",
) -> DataFrame:
    """Score month-0 customers of the snapshot and of each reference month in one scan."""
    months = [F.lit(day) for day in dict.fromkeys([snapshot, *reference])]
    rows = store.where(F.col("snapshot_date").isin(*months)).where(F.col("mob") == 0)
    usable = drop_if_all_null(rows, list(model.features))
    scored = score(model, usable, ["Customer_ID", "snapshot_date"])
    return scored.select(
        "Customer_ID", "snapshot_date", F.lit(model_name).alias("model_name"), "model_predictions"
    )


def linear_models(weights: DataFrame) -> dict[str, LinearModel]:
    """The linear models of a table (model_name, feature, weight), the constant's feature being `constant`.

    Models are read on the driver: one row per model and feature. A NULL weight counts as 0.
    """
    found: dict[str, dict[str, float]] = {}
    for r in weights.select("model_name", "feature", "weight").collect():
        found.setdefault(r["model_name"], {})[r["feature"]] = r["weight"] or 0.0
    models = {}
    for name, by in found.items():
        features = tuple(sorted(by.keys() - {"constant"}))
        models[name] = LinearModel(features, tuple(by[f] for f in features), by.get("constant", 0.0))
    return models


def score_deployed(
    store: DataFrame,
    deployments: DataFrame,
    models: Mapping[str, LinearModel | TreeModel | TrainedModel],
    months: Sequence[dt.date],
) -> DataFrame:
    """Score month-0 customers of several months, each month with the model deployed then, in one scan.

    A month's model is that of the latest deployment (snapshot_date, model_name) on or before it; of two
    on one day the later name counts. Months before the first deployment have no rows, and neither
    do customers without any feature of their month's model. Deployments, one row each, are resolved on
    the driver; rows never meet a model table.
    """
    known = sorted((r["snapshot_date"], r["model_name"]) for r in deployments.select("snapshot_date", "model_name").collect())
    months_of: dict[str, list[dt.date]] = {}
    for month in sorted(set(months)):
        earlier = [name for day, name in known if day <= month]
        if earlier:
            months_of.setdefault(earlier[-1], []).append(month)
    if missing := months_of.keys() - models.keys():
        raise KeyError(f"deployed models without a record: {sorted(missing)}")
    day, name, result = F.col("snapshot_date"), F.lit(None).cast("string"), F.lit(None).cast("double")
    for model, days in months_of.items():
        fitted = models[model].fitted if isinstance(models[model], TrainedModel) else models[model]
        usable = day.isin(*map(F.lit, days)) & F.coalesce(*[F.col(f).cast("double") for f in fitted.features]).isNotNull()
        name = F.when(usable, F.lit(model)).otherwise(name)
        result = F.when(usable, fitted.probability()).otherwise(result)
    wanted = [m for days in months_of.values() for m in days]
    rows = store.where(day.isin(*map(F.lit, wanted)) if wanted else F.lit(False)).where(F.col("mob") == 0)
    return rows.select(
        "Customer_ID", "snapshot_date", name.alias("model_name"), result.alias("model_predictions")
    ).where(F.col("model_name").isNotNull())


def registry_row(
    model: TrainedModel,
    results: DataFrame,
    stats: DataFrame,
    window: TrainingWindow = TrainingWindow(),
) -> DataFrame:
    """One registry row: metrics per split as columns, windows and parameters as JSON text."""
    days = split_dates(model.train_date, window)
    joined = results.join(stats.select("split", "label_rate"), "split")

    def at(split: str, column: str):
        return F.max(F.when(F.col("split") == split, F.col(column))).alias(f"{column}_{split}")

    splits = ("train", "test", "oot")
    wide = joined.agg(
        *[at(s, c) for c in ("auc", "gini", "n_rows", "label_rate") for s in splits]
    )
    return wide.select(
        F.lit(model.name).alias("model_name"),
        F.lit(model.family).alias("model_family"),
        F.lit(model.train_date).alias("snapshot_date"),
        *wide.columns,
        F.lit(json.dumps({k: str(v) for k, v in vars(days).items()})).alias("data_dates"),
        F.lit(json.dumps(dict(model.params))).alias("hp_params"),
        F.lit(",".join(model.features)).alias("features"),
    )


RECORD = (
    "model_name string, model_family string, train_date date, features array<string>, params string, cv_auc double, "
    "fitted string"
)


def save(spark: SparkSession, model: TrainedModel, folder: str) -> str:
    """Write the whole record of a model as one row."""
    path = f"{folder}/{model.name}"
    row = (
        model.name, model.family, model.train_date, list(model.features), json.dumps(dict(model.params)), model.cv_auc,
        model.fitted.as_json(),
    )
    spark.createDataFrame([row], RECORD).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def fitted_from(features: Sequence[str], text: str) -> LinearModel | TreeModel:
    """The model that `as_json` wrote."""
    found = json.loads(text)
    if found["kind"] == "linear":
        return LinearModel(tuple(features), tuple(found["weights"]), found["intercept"])
    return TreeModel(tuple(features), tuple(tuple(tuple(node) for node in tree) for tree in found["trees"]))


def load(spark: SparkSession, path: str) -> TrainedModel:
    """The model of a path as it was saved, with its parameters and score."""
    row = spark.read.schema(RECORD).parquet(path).first()
    features = tuple(row["features"])
    return TrainedModel(
        row["model_family"], row["train_date"], features, fitted_from(features, row["fitted"]), json.loads(row["params"]),
        row["cv_auc"],
    )
