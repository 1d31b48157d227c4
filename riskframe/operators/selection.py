"""Cross-validation, tuning, model ranking."""

from __future__ import annotations

import itertools
import random
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import Evaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.scalar import clamp01
from riskframe.operators import metrics as M
from riskframe.operators import cells, models, split
from riskframe.operators.lineage import cut, ready

# Interpretability per model type, and the metrics a ranking may use. Fixed values.
INTERPRETABILITY = {"baseline": 1.0, "random_forest": 0.6, "xgboost": 0.5, "lightgbm": 0.5}
PRIMARY_METRICS = ("f1", "pr_auc", "roc_auc")
DEFAULT_GRIDS = {
    "random_forest": {"n_estimators": [100, 200, 300], "max_depth": [10, 20, None], "min_samples_leaf": [1, 2, 4]},
    "xgboost": {
        "n_estimators": [100, 200, 300],
        "max_depth": [3, 5, 7],
        "learning_rate": [0.01, 0.1, 0.2],
        "subsample": [0.8, 0.9, 1.0],
    },
    "lightgbm": {"n_estimators": [100, 200, 300], "max_depth": [3, 5, 7], "learning_rate": [0.01, 0.1, 0.2]},
}


@dataclass
class CrossValidation:
    folds: DataFrame  # (fold, metric, value)
    summary: DataFrame  # (metric, mean, std, min, max)


def summarise_folds(folds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(metric, mean, std, min, max) over folds; population deviation, null values skipped."""
    return folds.groupBy(*by, "metric").agg(
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )


# Fits are many short jobs: a small table is quickest in few partitions with fits side by side, a large one stays as dealt.
ROWS_PER_PARTITION = 25_000
LARGE_TABLE = 10_000_000


def spread(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """The stored table in as many partitions as iterative fits make use of."""
    data = cut(df)
    n = data.count()
    if n > LARGE_TABLE:
        return data
    return cut(data.repartition(max(1, min(df.sparkSession.sparkContext.defaultParallelism, -(-n // ROWS_PER_PARTITION))), *key))


def fold_table(df: DataFrame, key: Sequence[str], features: Sequence[str], label: str, n_folds: int, seed: int) -> DataFrame:
    """Key, features, label and ``fold``, stored once; all fits of a comparison can read it."""
    return spread(split.folds(df.select(*key, *[f for f in features if f not in key], label), key, label, n_folds, seed), key)


def cross_validate(
    df: DataFrame,
    key: Sequence[str],
    kind: str,
    features: Sequence[str],
    label: str = "class",
    n_folds: int = 5,
    metrics: Sequence[str] | None = None,
    class_weight: str | dict | None = "balanced",
    seed: int = 42,
    folded: DataFrame | None = None,
    parallelism: int = 8,
    counted: cells.Cells | None = None,
    **params,
) -> CrossValidation:
    """Stratified k-fold: one fit per fold, side by side, all held-out rows scored and evaluated in one job.

    ``folded`` is a ``fold_table`` of the same arguments made before, ``counted`` its cells. Trees grow from cells where the
    rows of a fold table can be counted by them.
    """
    wrong = [m for m in metrics or () if m not in M.METRICS]
    if wrong:
        raise ValueError(f"Invalid metrics: {wrong}. Available: {list(M.METRICS)}")
    data = fold_table(df, key, features, label, n_folds, seed) if folded is None else folded
    if counted is None and kind in cells.KINDS:
        models.spark_params(kind, params)
        counted = cells.count(data, features, label, n_folds)
    if counted is not None and kind in cells.KINDS:
        fits = []
        for i in range(n_folds):
            weights = models.weights_by_class(counted.by_class(leave_out=i), class_weight, kind)
            fits.append(cells.Fit(kind, models.spark_params(kind, params), i, (weights.get(0, 1.0), weights.get(1, 1.0))))
        scored = cells.score_fits(data, counted, fits, seed).withColumnsRenamed({"fit": "fold", "label": label})
        folds = cut(M.evaluate(scored, label, by=["fold"], metrics=metrics, rows="n"))
        return CrossValidation(folds, summarise_folds(folds))

    def fit(i: int) -> DataFrame:
        model = models.train(data.where(F.col("fold") != i), kind, features, label, class_weight, seed, **params)
        return models.predict(model, data.where(F.col("fold") == i)).select("fold", label, "prediction", "score")

    with ThreadPool(parallelism) as pool:
        parts = pool.map(fit, range(n_folds), chunksize=1)
    scored = cut(reduce(DataFrame.unionByName, parts))
    folds = cut(M.evaluate(scored, label, by=["fold"], metrics=metrics))
    return CrossValidation(folds, summarise_folds(folds))


class ExactMetric(Evaluator):
    """One of the exact metrics of ``operators.metrics`` as an evaluator; undefined counts as 0."""

    def __init__(self, metric: str, label: str):
        super().__init__()
        self.metric, self.label = metric, label

    def _evaluate(self, dataset: DataFrame) -> float:
        scored = dataset.select(
            self.label, F.col("prediction").cast("int").alias("prediction"), vector_to_array("probability")[1].alias("score")
        )
        value = M.evaluate(scored, self.label, metrics=[self.metric]).first()["value"]
        return 0.0 if value is None else float(value)


# Metrics that Spark's own evaluator has. The others are ranked exactly.
_BY_LABEL = {"accuracy": "accuracy", "precision": "precisionByLabel", "recall": "recallByLabel", "f1": "fMeasureByLabel"}


def evaluator(scoring: str, label: str) -> Evaluator:
    """Judge of a search: any name of ``operators.metrics.METRICS``, for label 1."""
    if scoring not in M.METRICS:
        raise ValueError(f"Invalid scoring: {scoring}. Available: {list(M.METRICS)}")
    if scoring in _BY_LABEL:
        return MulticlassClassificationEvaluator(
            labelCol=label, predictionCol="prediction", metricName=_BY_LABEL[scoring], metricLabel=1.0
        )
    return ExactMetric(scoring, label)


@dataclass
class Tuning:
    model: PipelineModel
    best_params: dict
    best_score: float
    candidates: DataFrame  # (params, mean_score, std_score)


def expand_grid(grid: dict[str, list], search: str = "grid", n_iter: int = 20, seed: int = 42) -> list[dict]:
    """All combinations, or a seeded subset of them for a random search."""
    if search not in ("grid", "random"):
        raise ValueError(f"Invalid search: {search}. Must be 'grid' or 'random'")
    combos = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    if search == "random" and n_iter < len(combos):
        return random.Random(seed).sample(combos, n_iter)
    return combos


def tune(
    df: DataFrame,
    key: Sequence[str],
    kind: str,
    features: Sequence[str],
    label: str = "class",
    grid: dict[str, list] | None = None,
    cv: int = 5,
    search: str = "grid",
    n_iter: int = 20,
    class_weight: str | dict | None = "balanced",
    seed: int = 42,
    parallelism: int = 8,
    scoring: str = "f1",
    folded: DataFrame | None = None,
    counted: cells.Cells | None = None,
) -> Tuning:
    """Search the grid by a stratified k-fold metric (``scoring``), then refit the best on all rows.

    ``folded`` is a ``fold_table`` of the same arguments made before, ``counted`` its cells. Trees grow from cells where the
    rows of a fold table can be counted by them; an undefined metric counts as 0.
    """
    judge = evaluator(scoring, label)
    if grid is None and kind not in DEFAULT_GRIDS:
        raise ValueError(f"No default grid for {kind}; pass one")
    combos = expand_grid(grid if grid is not None else DEFAULT_GRIDS[kind], search, n_iter, seed)
    mapped = [models.spark_params(kind, c) for c in combos]
    counts = split.class_counts(df, label)
    weight, total = models.class_weights(df, label, class_weight, kind, counts)
    ready(df.sparkSession)
    data = fold_table(df, key, features, label, cv, seed) if folded is None else folded
    if weight is not None:
        data = data.withColumn(models.WEIGHT, weight)
    base = models.estimator(kind, label, seed, {}, total, weight is not None)
    maps = []
    for combo, spark_values in zip(combos, mapped):
        values = {base.getParam(n): v for n, v in spark_values.items()}
        if kind == "logistic_regression" and "C" in combo:
            values[base.regParam] = 1.0 / (combo["C"] * total)
        maps.append(values)
    flow = Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="features"), base])
    if counted is None and kind in cells.KINDS:
        counted = cells.count(data, features, label, cv)
    by_cells = counted is not None and kind in cells.KINDS
    if by_cells:
        weights = models.weights_by_class(counts, class_weight, kind)
        pair = (weights.get(0, 1.0), weights.get(1, 1.0))
        fits = [cells.Fit(kind, p, i, pair) for p in mapped for i in range(cv)]
        scored = cells.score_fits(data, counted, fits, seed, with_scores=scoring not in _BY_LABEL)
        # one row per fit
        found = M.evaluate(scored, "label", by=["fit"], metrics=[scoring], rows="n").collect()
        values = np.zeros(len(fits))
        for r in found:
            values[r["fit"]] = 0.0 if r["value"] is None else r["value"]
        means, deviations = values.reshape(-1, cv).mean(axis=1), values.reshape(-1, cv).std(axis=1)
    else:
        fitted = CrossValidator(
            estimator=flow, estimatorParamMaps=maps, evaluator=judge, numFolds=cv, foldCol="fold",
            parallelism=parallelism, seed=seed,
        ).fit(data)
        means, deviations = fitted.avgMetrics, fitted.stdMetrics
    best = max(range(len(maps)), key=lambda i: (means[i], -i))
    rows = [(str(c), float(m), float(s)) for c, m, s in zip(combos, means, deviations)]
    return Tuning(
        flow.fit(models.dealt(data, sum(counts.values())), maps[best]) if by_cells else fitted.bestModel,
        combos[best],
        float(means[best]),
        df.sparkSession.createDataFrame(rows, "params string, mean_score double, std_score double"),
    )


def check_ranking(metric: str, interpretability_weight: float, performance_weight: float) -> None:
    if metric not in PRIMARY_METRICS:
        raise ValueError(f"Invalid primary_metric: {metric}. Must be one of {list(PRIMARY_METRICS)}")
    if abs(interpretability_weight + performance_weight - 1.0) > 1e-6:
        raise ValueError("The two ranking weights must equal 1.0 together")


def leaderboard(
    test: DataFrame,
    cv: DataFrame | None = None,
    primary_metric: str = "f1",
    interpretability_weight: float = 0.3,
    performance_weight: float = 0.7,
) -> DataFrame:
    """One row per model with its metrics, scores and place.

    ``test``: (model_name, model_type, interpretability_score, metric, value); ``cv``:
    (model_name, metric, mean, std). Performance is the CV mean less its deviation where
    given, else the test value, clamped to [0, 1] and min-max normalised over the models
    (1 when all are equal). Ties go to the first name.
    """
    check_ranking(primary_metric, interpretability_weight, performance_weight)
    ids = ["model_name", "model_type", "interpretability_score"]
    names = list(M.METRICS)
    wide = test.groupBy(*ids).pivot("metric", names).agg(F.first("value"))
    wide = wide.select(*ids, *[F.col(m).alias(f"test_{m}") for m in names])
    primary = F.coalesce(F.col(f"test_{primary_metric}"), F.lit(0.0))
    if cv is not None:
        spread = cv.groupBy("model_name").pivot("metric", names).agg(F.first("mean").alias("mean"), F.first("std").alias("std"))
        spread = spread.select(
            "model_name", *[F.col(f"{m}_{s}").alias(f"cv_{m}_{s}") for m in names for s in ("mean", "std")]
        )
        wide = wide.join(spread, "model_name", "left")
        primary = F.coalesce(F.col(f"cv_{primary_metric}_mean") - F.col(f"cv_{primary_metric}_std"), primary)
    scored = wide.withColumn("performance_score", clamp01(primary))
    return rank_models(scored, interpretability_weight, performance_weight)


def rank_models(scored: DataFrame, interpretability_weight: float, performance_weight: float) -> DataFrame:
    """Add normalised_performance, overall_score and place; the table has one row per model."""
    models_window = Window.partitionBy(F.lit(0))
    low, high = F.min("performance_score").over(models_window), F.max("performance_score").over(models_window)
    normalised = F.when(high == low, 1.0).otherwise((F.col("performance_score") - low) / (high - low))
    overall = F.lit(performance_weight) * F.col("normalised_performance") + F.lit(interpretability_weight) * F.col(
        "interpretability_score"
    )
    place = F.row_number().over(models_window.orderBy(F.desc("overall_score"), "model_name"))
    return (
        scored.withColumn("normalised_performance", normalised)
        .withColumn("overall_score", overall)
        .withColumn("place", place)
    )


def leaderboard_profiles(test: DataFrame, profiles: dict[str, tuple[float, float]], cv=None, primary_metric="f1") -> DataFrame:
    """The ranking under several (performance, interpretability) weights: (profile, model_name, overall_score, place)."""
    parts = []
    for name, (performance, interpretability) in profiles.items():
        board = leaderboard(test, cv, primary_metric, interpretability, performance)
        parts.append(board.select(F.lit(name).alias("profile"), "model_name", "overall_score", "place"))
    return reduce(DataFrame.unionByName, parts)


def margins(board: DataFrame, primary_metric: str = "f1") -> DataFrame:
    """(best_model, other_model, margin): where the best model's test metric is greater."""
    best = board.where("place = 1").select(
        F.struct(F.col("model_name").alias("name"), F.coalesce(f"test_{primary_metric}", F.lit(0.0)).alias("value"))
    ).scalar()
    return (
        board.where("place > 1")
        .withColumn("b", best)
        .select(
            F.col("b.name").alias("best_model"),
            F.col("model_name").alias("other_model"),
            (F.col("b.value") - F.coalesce(f"test_{primary_metric}", F.lit(0.0))).alias("margin"),
        )
        .where("margin > 0")
    )


def board_summary(board: DataFrame, primary_metric: str = "f1") -> DataFrame:
    """One row: the best model, its scores, the ranking as text, the number of models."""
    top = F.min_by(
        F.struct("model_name", "model_type", "overall_score", "performance_score", "interpretability_score", f"test_{primary_metric}"),
        "place",
    )
    ranking = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "model_name"))), lambda r: r["model_name"]), ", ")
    return board.agg(top.alias("b"), ranking.alias("ranking"), F.count(F.lit(1)).alias("total_models_compared")).select(
        F.col("b.model_name").alias("best_model"),
        F.col("b.model_type").alias("best_model_type"),
        F.col("b.overall_score").alias("best_overall_score"),
        F.col("b.performance_score").alias("best_performance_score"),
        F.col("b.interpretability_score").alias("best_interpretability_score"),
        F.col(f"b.test_{primary_metric}").alias("primary_metric_value"),
        "ranking",
        "total_models_compared",
    )
