"""Train, cross-validate and rank several models on one dataset; write the summary."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import cells, clean, encode, models, selection, split
from riskframe.operators import metrics as M
from riskframe.operators.lineage import cut
from riskframe.sources import tables


@dataclass
class Candidate:
    """A model to compare. With a grid it is tuned first."""

    name: str
    kind: str
    model_type: str
    interpretability: float
    params: dict
    grid: dict | None = None
    search: str = "grid"
    n_iter: int = 10


# The candidates of the full comparison. Fixed values.
CANDIDATES = (
    Candidate("Logistic Regression", "logistic_regression", "baseline", 1.0, {}),
    Candidate("Random Forest", "random_forest", "random_forest", 0.6, {}, {"n_estimators": [100, 200], "max_depth": [10, 20, None]}),
    # Spark has one kind of boosted trees, so there is one booster to compare.
    Candidate(
        "Gradient Boosting", "gradient_boosting", "gradient_boosting", 0.5, {},
        {"n_estimators": [100, 200], "max_depth": [3, 5, 7], "learning_rate": [0.1, 0.2]}, "random",
    ),
)


@dataclass
class Comparison:
    board: DataFrame
    test_metrics: DataFrame
    cv_summary: DataFrame
    models: dict[str, PipelineModel]
    features: list[str]


def numeric_inputs(df: DataFrame, key: Sequence[str], dataset: str) -> tuple[DataFrame, list[str]]:
    """Feature table for the estimators: text columns become label codes."""
    conf = clean.DATASETS[dataset]
    names = clean.feature_columns(df, conf["target"], [*conf["exclude"], *key])
    text = [c for c in clean.string_columns(df) if c in names]
    kept = df.select(*key, *names, conf["target"])
    if text:
        kept = encode.label_apply(kept, encode.label_fit(kept, text), text, drop_original=True)
    return kept, [*[n for n in names if n not in text], *[f"{c}_idx" for c in text]]


def train_and_compare(
    df: DataFrame,
    key: Sequence[str],
    dataset: str = "ecommerce",
    candidates: Sequence[Candidate] = CANDIDATES,
    n_folds: int = 5,
    primary_metric: str = "f1",
    seed: int = 42,
) -> Comparison:
    """Split once, then tune, fit, test and cross-validate each candidate, and rank them."""
    label = clean.DATASETS[dataset]["target"]
    data, features = numeric_inputs(df, key, dataset)
    marked = selection.spread(split.stratified(data, key, label, seed=seed), key)
    train, test = marked.where("split = 'train'").drop("split"), marked.where("split = 'test'").drop("split")
    folded = selection.fold_table(train, key, features, label, n_folds, seed)
    counted = cells.count(folded, features, label, n_folds) if any(c.kind in cells.KINDS for c in candidates) else None

    def judge(c: Candidate) -> tuple[PipelineModel, DataFrame, DataFrame]:
        """The fitted model, its judgement of the test rows, its cross-validation."""
        params = dict(c.params)
        if c.grid:
            found = selection.tune(
                train, key, c.kind, features, label, c.grid, n_folds, c.search, c.n_iter, seed=seed, folded=folded, counted=counted
            )
            model, params = found.model, {**params, **found.best_params}
        else:
            model = models.train(train, c.kind, features, label, seed=seed, **params)
        scored = models.predict(model, test).select(
            F.lit(c.name).alias("model_name"),
            F.lit(c.model_type).alias("model_type"),
            F.lit(c.interpretability).alias("interpretability_score"),
            label,
            "prediction",
            "score",
        )
        cv = selection.cross_validate(train, key, c.kind, features, label, n_folds, seed=seed, folded=folded, counted=counted, **params)
        return model, scored, cv.summary.select(F.lit(c.name).alias("model_name"), "*")

    # Fits are many short jobs that wait for each other, so the candidates are judged side by side.
    with ThreadPool(max(1, len(candidates))) as pool:
        judged = pool.map(judge, candidates, chunksize=1)
    fitted = {c.name: model for c, (model, _, _) in zip(candidates, judged)}
    scored, cv_parts = [s for _, s, _ in judged], [s for _, _, s in judged]
    ids = ["model_name", "model_type", "interpretability_score"]
    test_metrics = cut(M.evaluate(cut(reduce(DataFrame.unionByName, scored)), label, by=ids))
    cv_summary = cut(reduce(DataFrame.unionByName, cv_parts))
    board = selection.leaderboard(test_metrics, cv_summary, primary_metric)
    return Comparison(board, test_metrics, cv_summary, fitted, features)


def save_json_summary(comparison: Comparison, path: str, dataset: str) -> None:
    """Write the ranking and the cross-validation summary as JSON lines."""
    tables.save(comparison.board.withColumn("dataset", F.lit(dataset)), f"{path}/leaderboard", "json")
    tables.save(comparison.cv_summary.withColumn("dataset", F.lit(dataset)), f"{path}/cross_validation", "json")
