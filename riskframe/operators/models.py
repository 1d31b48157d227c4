"""Spark ML classifiers behind one train / predict / evaluate interface."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators import metrics as M
from riskframe.operators.clean import require_columns
from riskframe.operators.lineage import cut, ready
from riskframe.operators.split import class_counts

WEIGHT = "weight__"
SOLVERS = ("lbfgs", "liblinear", "newton-cg", "sag", "saga")

# Defaults and parameter names of each kind: user name -> Spark name. Fixed values.
_TREE_NAMES = {"n_estimators": "maxIter", "max_depth": "maxDepth", "learning_rate": "stepSize", "subsample": "subsamplingRate"}
KINDS = {
    "logistic_regression": ({"max_iter": 1000, "C": 1.0}, {"max_iter": "maxIter"}),
    "random_forest": (
        {"n_estimators": 100, "max_depth": None, "min_samples_leaf": 1},
        {"n_estimators": "numTrees", "max_depth": "maxDepth", "min_samples_leaf": "minInstancesPerNode"},
    ),
    "gradient_boosting": ({"n_estimators": 100, "max_depth": 3, "learning_rate": 0.1}, _TREE_NAMES),
    "xgboost": ({"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3}, _TREE_NAMES),
    "lightgbm": ({"n_estimators": 100, "max_depth": 5, "learning_rate": 0.1}, _TREE_NAMES),
}
# The deepest tree Spark ML grows; stands for "no limit".
MAX_DEPTH = 30
# Tree fits keep a row with its count in every tree; a task holds so many rows at most, and all cores get rows before that.
ROWS_PER_TASK = 100_000
ROWS_WORTH_A_TASK = 25_000


def spark_params(kind: str, params: dict) -> dict:
    """Translate user parameters; a parameter without a Spark counterpart is an error, never ignored."""
    if kind not in KINDS:
        raise ValueError(f"Unsupported model kind: {kind}. Must be one of {list(KINDS)}")
    defaults, names = KINDS[kind]
    merged = {**defaults, **params}
    out = {}
    for name, value in merged.items():
        if kind == "logistic_regression" and name in ("C", "solver"):
            continue
        if name not in names:
            raise ValueError(f"Parameter '{name}' of {kind} has no Spark counterpart")
        if name == "max_depth":
            if value is None and kind == "random_forest":
                value = MAX_DEPTH
            if value is None or value < 0:
                raise ValueError(f"max_depth={value} of {kind} has no Spark counterpart")
        out[names[name]] = value
    return out


def weights_by_class(counts: dict, class_weight: str | dict | None, kind: str) -> dict:
    """Weight per class; a class that is not named weighs 1.

    Balanced means n / (classes * n_c), or n0/n1 on positives for boosters.
    """
    if class_weight is None:
        return {}
    if isinstance(class_weight, dict):
        return class_weight
    if class_weight != "balanced":
        raise ValueError(f"Invalid class_weight: {class_weight}. Must be 'balanced', None, or a dict")
    if kind in ("logistic_regression", "random_forest"):
        n = sum(counts.values())
        return {c: n / (len(counts) * m) for c, m in counts.items()}
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    return {0: 1.0, 1: n0 / n1 if n0 and n1 else 1.0}


def class_weights(df: DataFrame, label: str, class_weight: str | dict | None, kind: str, counts: dict | None = None):
    """(weight expression or None, sum of the weights); see ``weights_by_class``.

    The sum follows from the class counts, without another pass; ``counts`` are those counted before.
    """
    counts = class_counts(df, label) if counts is None else counts
    weights = weights_by_class(counts, class_weight, kind)
    if class_weight is None:
        return None, float(sum(counts.values()))
    out = F.lit(1.0)
    for c, w in weights.items():
        out = F.when(F.col(label) == c, F.lit(float(w))).otherwise(out)
    return out, float(sum(weights.get(c, 1.0) * n for c, n in counts.items()))


def estimator(kind: str, label: str, seed: int, params: dict, total_weight: float | None = None, weighted=True):
    """The Spark ML classifier. Logistic regression penalises as C times the summed loss does."""
    p = spark_params(kind, params)
    common = {"labelCol": label, "featuresCol": "features"}
    if weighted:
        common["weightCol"] = WEIGHT
    if kind == "logistic_regression":
        c = params.get("C", KINDS[kind][0]["C"])
        reg = 1.0 / (c * total_weight) if total_weight else 0.0
        return LogisticRegression(**common, **p, regParam=reg, elasticNetParam=0.0, standardization=False)
    if kind == "random_forest":
        # Rows remember their node, so a level of deep trees does not ship the forest grown so far to every task.
        return RandomForestClassifier(**common, **p, seed=seed, cacheNodeIds=True, maxMemoryInMB=512)
    return GBTClassifier(**common, **p, seed=seed)


def dealt(data: DataFrame, n_rows: int) -> DataFrame:
    """The rows of a tree fit in partitions of bounded size, however few the table came in."""
    cores = data.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-n_rows // ROWS_PER_TASK), min(cores, -(-n_rows // ROWS_WORTH_A_TASK)))
    return data.repartition(parts) if parts > 1 else data


def train(
    df: DataFrame,
    kind: str,
    features: Sequence[str],
    label: str = "class",
    class_weight: str | dict | None = "balanced",
    seed: int = 42,
    **params,
) -> PipelineModel:
    """Fit vector assembly plus classifier. Weights follow the class counts of ``df``."""
    require_columns(df, [*features, label])
    if params.get("solver", "lbfgs") not in SOLVERS:
        raise ValueError(f"Invalid solver: {params['solver']}. Must be one of {list(SOLVERS)}")
    spark_params(kind, params)  # reject bad input before any job
    ready(df.sparkSession)
    counts = class_counts(df, label)
    weight, total = class_weights(df, label, class_weight, kind, counts)
    data = df.select(*features, label).dropna(subset=[label])
    if kind != "logistic_regression":
        data = dealt(data, sum(counts.values()))
    if weight is not None:
        data = data.withColumn(WEIGHT, weight)
    assembler = VectorAssembler(inputCols=list(features), outputCol="features")
    model = estimator(kind, label, seed, params, total, weight is not None)
    return Pipeline(stages=[assembler, model]).fit(data)


def predict(model: PipelineModel, df: DataFrame, return_proba: bool = True) -> DataFrame:
    """Add ``prediction`` (int) and, on request, ``score`` = probability of label 1."""
    extra = {"prediction": F.col("prediction").cast("int")}
    if return_proba:
        extra["score"] = vector_to_array("probability")[1]
    out = model.transform(df).withColumns(extra)
    return out.select(*df.columns, *extra)


@dataclass
class TrainedModel:
    model: PipelineModel
    metrics: DataFrame  # (split, metric, value)
    predictions: DataFrame  # rows of both splits with split, prediction, score


def evaluate(model: PipelineModel, df: DataFrame, label: str = "class", metrics=None) -> DataFrame:
    """(metric, value) of the model on the table."""
    return M.evaluate(predict(model, df), label, metrics=metrics)


def train_and_evaluate(
    train_df: DataFrame, test_df: DataFrame, kind: str, features: Sequence[str], label: str = "class",
    class_weight: str | dict | None = "balanced", seed: int = 42, **params,
) -> TrainedModel:
    """Fit on train, score train and test in one table, evaluate both."""
    model = train(train_df, kind, features, label, class_weight, seed, **params)
    both = train_df.withColumn("split", F.lit("train")).unionByName(test_df.withColumn("split", F.lit("test")))
    scored = cut(predict(model, both))  # the metrics read it more than once
    return TrainedModel(model, M.evaluate(scored, label, by=["split"]), scored)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
