"""Per-row feature attributions (phi): linear, tree, and sampled Shapley values.

All return a long table (key..., feature, value, phi, base_value), where
base_value + sum of phi = model output of the row.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel, LogisticRegressionModel, RandomForestClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.functions.scalar import hash32
from riskframe.operators import coalitions, models, split
from riskframe.operators import order as hash_order
from riskframe.operators.clean import require_columns
from riskframe.operators.lineage import cut, work_dir

LEAVES_AT_ONCE = 64
ROWS_AT_ONCE = 256
# A background sample up to this size is broadcast; a larger one is joined by its number.
BROADCAST_BACKGROUND = 10_000


def linear_phi(
    df: DataFrame, key: Sequence[str], weights: dict[str, float], background: DataFrame | None = None, intercept: float = 0.0
) -> DataFrame:
    """phi = w (x - mean of x over the background); plain column expressions."""
    features = list(weights)
    require_columns(df, [*key, *features])
    means = (df if background is None else background).agg(*[F.avg(c).alias(c) for c in features]).first()
    base = intercept + sum(weights[c] * means[c] for c in features)
    rows = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(c).cast("double").alias("value"),
            (F.lit(float(weights[c])) * (F.col(c) - F.lit(means[c]))).alias("phi"),
        )
        for c in features
    ]
    return df.select(*key, F.inline(F.array(*rows))).withColumn("base_value", F.lit(base))


@dataclass
class LeafTable:
    """All leaves of an ensemble as arrays, one row per leaf, padded to the longest path.

    A leaf is reached by rows with low < x <= high for its features; ``share`` is the part
    of the training weight that follows the path past each feature's splits.
    """

    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: np.ndarray

    @property
    def base(self) -> float:
        return float((self.value * self.share.prod(axis=1)).sum())


def packed_trees(model, folder: str | None = None) -> DataFrame:
    """(tree, packed) of a Spark forest (probability of label 1) or boosted ensemble (margin).

    The nodes come from the saved model files in the shared ``folder`` (default: the checkpoint folder) and are packed by
    tasks, one tree each: arrays, averages and coalition tables of ``coalitions``.
    """
    spark = SparkSession.active()
    if isinstance(model, RandomForestClassificationModel):
        forest = True
    elif isinstance(model, GBTClassificationModel):
        forest = False
    else:
        raise ValueError(f"No tree attribution for {type(model).__name__}")
    path = f"{folder or work_dir(spark)}/tree-model-{uuid.uuid4().hex}"
    model.write().save(path)
    weights = [1.0 / len(model.treeWeights)] * len(model.treeWeights) if forest else list(model.treeWeights)

    def run(key: tuple, nodes: pd.DataFrame) -> pd.DataFrame:
        tree = coalitions.pack(nodes, forest, weights[int(key[0])])
        return pd.DataFrame({"tree": [int(key[0])], "packed": [coalitions.dumps(tree)]})

    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    nodes = nodes.select("treeID", "id", "leftChild", "rightChild", "impurityStats", "prediction", "split")
    packed = nodes.repartition(min(len(weights), spark.sparkContext.defaultParallelism), "treeID").groupBy("treeID").applyInPandas(run, "tree int, packed binary")
    packed.write.parquet(f"{path}/packed")
    return spark.read.schema("tree int, packed binary").parquet(f"{path}/packed")


def _padded(paths: list[tuple[dict, float]]) -> LeafTable:
    depth = max(1, max(len(p) for p, _ in paths))
    shape = (len(paths), depth)
    out = LeafTable(
        np.zeros(shape, dtype=int), np.full(shape, -np.inf), np.full(shape, np.inf), np.ones(shape), np.zeros(len(paths))
    )
    for i, (path, value) in enumerate(paths):
        out.value[i] = value
        for j, (f, (low, high, share)) in enumerate(path.items()):
            out.feature[i, j], out.low[i, j], out.high[i, j], out.share[i, j] = f, low, high, share
    return out


def leaf_table(model, folder: str | None = None) -> LeafTable:
    """All leaves of a model."""
    rows = packed_trees(model, folder).orderBy("tree").collect()
    return _padded([leaf for r in rows for leaf in coalitions.leaves(coalitions.loads(r["packed"]))])


def leaf_phi(x: np.ndarray, leaves: LeafTable) -> np.ndarray:
    """Shapley values of the path-dependent tree game for each row of x.

    For one leaf the game is a product over its path features of ``reached`` (feature
    known) or ``share`` (unknown). The Shapley value of such a product is the integral
    over t in [0, 1] of the other factors, each mixed as (1 - t) share + t reached; the
    integrand is a polynomial, so Gauss-Legendre quadrature is exact.
    """
    depth = leaves.feature.shape[1]
    points, weights = np.polynomial.legendre.leggauss(depth // 2 + 1)
    t, w = (points + 1) / 2, weights / 2
    phi = np.zeros_like(x)
    for start in range(0, len(leaves.value), LEAVES_AT_ONCE):
        s = slice(start, start + LEAVES_AT_ONCE)
        values = x[:, leaves.feature[s]]
        reached = ((values > leaves.low[s]) & (values <= leaves.high[s])).astype(float)
        mixed = leaves.share[s][None, :, :, None] * (1 - t) + reached[..., None] * t
        ahead = np.ones_like(mixed)
        ahead[:, :, 1:] = np.cumprod(mixed, axis=2)[:, :, :-1]
        behind = np.ones_like(mixed)
        behind[:, :, :-1] = np.cumprod(mixed[:, :, ::-1], axis=2)[:, :, ::-1][:, :, 1:]
        others = (ahead * behind) @ w
        part = others * (reached - leaves.share[s]) * leaves.value[s][None, :, None]
        onehot = np.zeros((part.shape[1] * depth, x.shape[1]))
        onehot[np.arange(len(onehot)), leaves.feature[s].ravel()] = 1.0
        phi += part.reshape(len(x), -1) @ onehot
    return phi


def _classifier(model: PipelineModel):
    return model.stages[-1]


def tree_phi(
    model: PipelineModel, df: DataFrame, key: Sequence[str], features: Sequence[str], folder: str | None = None
) -> DataFrame:
    """Tree attributions of every row, from coalition tables (trees of many features: from their leaves).

    The packed trees, as large as the model that Spark's own ``transform`` ships to every task, are broadcast.
    """
    require_columns(df, [*key, *features])
    features = list(features)
    blobs = [r["packed"] for r in packed_trees(_classifier(model), folder).orderBy("tree").collect()]
    base = sum(float(coalitions.loads(b)["mean"][0]) for b in blobs)
    shared = df.sparkSession.sparkContext.broadcast(blobs)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            x = pdf[features].to_numpy(dtype=float)
            phi = np.zeros_like(x)
            for blob in shared.value:
                tree = coalitions.loads(blob)
                if len(tree["used"]) <= coalitions.MAX_FEATURES:
                    phi += coalitions.phi(tree, x)
                    continue
                table = _padded(coalitions.leaves(tree))
                for start in range(0, len(x), ROWS_AT_ONCE):
                    phi[start : start + ROWS_AT_ONCE] += leaf_phi(x[start : start + ROWS_AT_ONCE], table)
            yield pdf[list(key)].assign(xs=list(x), phis=list(phi))

    rows = df.select(*key, *[F.col(c).cast("double").alias(c) for c in features])
    # A row takes as much time as hundreds of rows of a scan, so they are spread over all cores.
    rows = rows.repartition(max(df.sparkSession.sparkContext.defaultParallelism, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    key_ddl = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in key)
    names = F.array(*[F.lit(c) for c in features])
    wide = rows.mapInPandas(explain, f"{key_ddl}, xs array<double>, phis array<double>")
    long = wide.select(*key, F.inline(F.arrays_zip(names.alias("feature"), "xs", "phis")))
    return long.select(
        *key, "feature", F.col("xs").alias("value"), F.col("phis").alias("phi"), F.lit(base).alias("base_value")
    )


def _linear_score(model: PipelineModel, features: Sequence[str]) -> tuple[np.ndarray, float] | None:
    """(weights, intercept) of a two-class logistic model of just these features, else None."""
    first, last = model.stages[0], _classifier(model)
    if len(model.stages) != 2 or not isinstance(last, LogisticRegressionModel) or not isinstance(first, VectorAssembler):
        return None
    if first.getInputCols() != list(features) or last.numClasses != 2 or last.coefficientMatrix.numRows != 1:
        return None
    return np.array(last.coefficients, dtype=float), float(last.intercept)


def _linear_gains(draws: DataFrame, key: Sequence[str], features: Sequence[str], places: list, line: tuple[np.ndarray, float]) -> DataFrame:
    """(key, own values, gains per feature, base score) of every draw. Along a permutation one term of the margin changes at
    a step, so its scores follow from one running sum, without a row per step."""
    weights, intercept = line
    d, n_key = len(features), len(key)
    rows = draws.select(
        *key, F.array(*features).alias("own__"), F.array(*[f"bg_{c}" for c in features]).alias("bg__"), F.array(*places).alias("places__")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, bg, places = (batch.column(n_key + i).flatten().to_numpy(zero_copy_only=False).reshape(-1, d) for i in range(3))
            if np.isnan(own).any() or np.isnan(bg).any():
                raise ValueError("Rows to explain and background rows need values in all features")
            order = np.argsort(places, axis=1, kind="stable")
            terms = np.take_along_axis(weights * own - weights * bg, order, axis=1)
            start = (weights * bg).sum(axis=1, keepdims=True) + intercept
            with np.errstate(over="ignore"):
                score = 1.0 / (1.0 + np.exp(-np.concatenate([start, start + np.cumsum(terms, axis=1)], axis=1)))
            gains = np.empty_like(own)
            np.put_along_axis(gains, order, np.diff(score, axis=1), axis=1)
            ends = pa.array(np.arange(0, gains.size + 1, d, dtype=np.int32))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: n_key + 1], pa.ListArray.from_arrays(ends, pa.array(gains.ravel())), pa.array(score[:, 0])],
                [*key, "own__", "gains__", "base__"],
            )

    key_ddl = "".join(f"`{k}` {rows.schema[k].dataType.simpleString()}, " for k in key)
    return rows.mapInArrow(run, f"{key_ddl}own__ array<double>, gains__ array<double>, base__ double")


def sampled_phi(
    model: PipelineModel,
    df: DataFrame,
    key: Sequence[str],
    features: Sequence[str],
    background: DataFrame,
    n_permutations: int = 20,
    n_background: int = 100,
    seed: int = 42,
) -> DataFrame:
    """Shapley values of any classifier's score, by permutation sampling.

    For each row and permutation, features switch one after another from a background row
    to the row's own values; a feature's share is the change of the score when it
    switches. All mixed rows are scored in one ``transform``, those of a logistic model from
    running sums of its margin. The background sample is a table of ``n_background`` numbered
    rows, of any size.
    """
    features = list(features)
    require_columns(df, [*key, *features])
    numbered = hash_order.hash_rank(background.select(*key, *features), [], key, seed, "rank__")
    bg = cut(
        numbered.where(F.col("rank__") <= n_background).select(
            (F.col("rank__") - 1).cast("int").alias("b__"), *[F.col(c).cast("double").alias(f"bg_{c}") for c in features]
        )
    )
    n_bg = bg.count()
    d = len(features)
    draws = (
        df.select(*key, *[F.col(c).cast("double").alias(c) for c in features])
        .withColumn("p__", F.explode(F.sequence(F.lit(1), F.lit(n_permutations))))
        .withColumn("b__", F.pmod(hash32([*key, "p__"], seed), F.lit(n_bg)).cast("int"))
        .join(F.broadcast(bg) if n_bg <= BROADCAST_BACKGROUND else bg, "b__")
    )
    places = [hash32([*key, "p__", F.lit(c)], seed) for c in features]
    line = _linear_score(model, features)
    if line is not None:
        drawn = _linear_gains(draws, key, features, places, line)
        own = [F.col("own__")[i].alias(f"own_{c}") for i, c in enumerate(features)]
        gains = [(F.sum(F.col("gains__")[i]) / n_permutations).alias(f"phi_{c}") for i, c in enumerate(features)]
        per_row = drawn.groupBy(*key, *own).agg(*gains, F.avg("base__").alias("base_value"))
        return _long_phi(per_row, key, features)
    order = F.transform(
        F.array_sort(F.array(*[F.struct(h.alias("h"), F.lit(i).alias("i")) for i, h in enumerate(places)])), lambda s: s["i"]
    )
    steps = draws.withColumn("order__", order).withColumn("j__", F.explode(F.sequence(F.lit(0), F.lit(d))))
    ranks = {f"r_{c}": F.array_position("order__", F.lit(i)) for i, c in enumerate(features)}  # 1-based
    ranked = steps.withColumns(ranks)
    mixed = ranked.select(
        *key,
        "j__",
        *ranks,
        *[F.col(c).alias(f"own_{c}") for c in features],
        *[F.when(F.col(f"r_{c}") <= F.col("j__"), F.col(c)).otherwise(F.col(f"bg_{c}")).alias(c) for c in features],
    )
    scored = models.predict(model, mixed)
    gains = [
        (
            F.sum(
                F.when(F.col("j__") == F.col(f"r_{c}"), F.col("score"))
                .when(F.col("j__") == F.col(f"r_{c}") - 1, -F.col("score"))
                .otherwise(0.0)
            )
            / n_permutations
        ).alias(f"phi_{c}")
        for c in features
    ]
    per_row = scored.groupBy(*key, *[f"own_{c}" for c in features]).agg(
        *gains, F.avg(F.when(F.col("j__") == 0, F.col("score"))).alias("base_value")
    )
    return _long_phi(per_row, key, features)


def _long_phi(per_row: DataFrame, key: Sequence[str], features: Sequence[str]) -> DataFrame:
    rows = [
        F.struct(F.lit(c).alias("feature"), F.col(f"own_{c}").alias("value"), F.col(f"phi_{c}").alias("phi"))
        for c in features
    ]
    return per_row.select(*key, F.inline(F.array(*rows)), "base_value")


def explain_model(
    model: PipelineModel,
    df: DataFrame,
    key: Sequence[str],
    features: Sequence[str],
    n_rows: int | None = None,
    background: DataFrame | None = None,
    seed: int = 42,
) -> DataFrame:
    """Attributions by the method that fits the model, on a seeded sample of rows (None: all rows)."""
    rows = df if n_rows is None else split.sample_rows(df, key, n_rows, seed)
    last = _classifier(model)
    if isinstance(last, (RandomForestClassificationModel, GBTClassificationModel)):
        return tree_phi(model, rows, key, features)
    if hasattr(last, "coefficients"):
        weights = dict(zip(features, [float(w) for w in last.coefficients]))
        return linear_phi(rows, key, weights, df if background is None else background, float(last.intercept))
    return sampled_phi(model, rows, key, features, df if background is None else background, seed=seed)
