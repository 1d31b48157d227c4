"""Class imbalance: weights, strategy choice, undersampling, synthetic minority rows, pipelines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.scalar import hash32, uniform
from riskframe.operators import knn, order, scale
from riskframe.operators.clean import require_columns
from riskframe.operators.lineage import cut
from riskframe.operators.profile import imbalance
from riskframe.operators.split import class_counts

STRATEGIES = (None, "smote", "undersample", "smote_undersample")


def class_weights(df: DataFrame, label: str = "class") -> DataFrame:
    """(label, n, weight) with weight = all rows / (classes * rows of the class)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = counts.agg(F.struct(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))).scalar()
    return counts.select(label, "n", (totals["rows"] / (totals["classes"] * F.col("n"))).alias("weight"))


def scale_pos_weight(df: DataFrame, label: str = "class") -> DataFrame:
    """One row: n0 / n1, or 1.0 when only one class is present."""
    n0, n1 = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    return df.agg(F.when((n0 > 0) & (n1 > 0), n0 / n1).otherwise(1.0).alias("scale_pos_weight"))


def choose_strategy(df: DataFrame, label: str = "class") -> DataFrame:
    """One row: imbalance ratio, strategy, and its oversampling and undersampling ratios.

    Above 100: smote 0.1 then undersample 0.5; above 10: smote 0.5; above 5: smote 0.3;
    else class weights.
    """
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("normal_count"), F.count_if(F.col(label) == 1).alias("fraud_count")
    )
    r = F.col("imbalance_ratio")
    return counts.withColumn("imbalance_ratio", imbalance(F.col("normal_count"), F.col("fraud_count"))).select(
        "*",
        F.when(r > 100, "smote_undersample").when(r > 5, "smote").otherwise("class_weights").alias("strategy"),
        F.when(r > 100, 0.1).when(r > 10, 0.5).when(r > 5, 0.3).alias("smote_ratio"),
        F.when(r > 100, 0.5).alias("under_ratio"),
    )


def _sides(df: DataFrame, label: str) -> tuple[dict, object, object]:
    counts = class_counts(df, label)
    if len(counts) != 2:
        raise ValueError(f"Resampling needs two classes, found {sorted(counts)}")
    low, high = sorted(counts, key=lambda c: (counts[c], -c))
    return counts, low, high


def undersample(
    df: DataFrame, key: Sequence[str], label: str = "class", ratio: float = 1.0, seed: int = 42
) -> DataFrame:
    """Keep all minority rows and minority / ratio majority rows, those with the smallest key hash."""
    counts, low, high = _sides(df, label)
    take = {low: counts[low], high: min(counts[high], int(counts[low] / ratio))}
    return order.mark_smallest(df, take, label, key, seed, "kept__").where("kept__").drop("kept__")


def smote(
    df: DataFrame,
    key: Sequence[str],
    label: str = "class",
    features: Sequence[str] | None = None,
    ratio: float = 1.0,
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Add synthetic minority rows until minority = ratio * majority.

    A synthetic row lies between a minority row and one of its k nearest minority rows.
    Every minority row is the base of the same number of synthetic rows (give or take
    one); neighbour and position come from the hash of base key and copy number. Columns
    of the result: key (of the base, for synthetic rows), features, label, ``copy`` (0 for
    an original row, else 1, 2, ...).
    """
    features = list(features) if features is not None else [c for c in df.columns if c not in {*key, label}]
    require_columns(df, [*key, *features, label])
    counts, low, high = _sides(df, label)
    wanted = int(counts[high] * ratio) - counts[low]
    numbers = [F.col(c).cast("double").alias(c) for c in features]
    original = df.select(*key, *numbers, label, F.lit(0).alias("copy"))
    if wanted <= 0:
        return original
    if df.where(F.col(label) == low).where(F.greatest(*[(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).cast("int") for c in features], F.lit(0)) > 0).limit(1).count():
        raise ValueError("The minority rows have null or NaN features; fill or drop them before SMOTE")
    each, extra = divmod(wanted, counts[low])
    vid = F.md5(F.concat_ws(",", *[F.col(c).cast("string") for c in features]))
    minority = df.where(F.col(label) == low).select(*key, *numbers).withColumn("vid", vid)
    points = minority.groupBy("vid").agg(
        F.count(F.lit(1)).alias("n"), F.first(F.array(*features)).alias("vec")
    )
    near = knn.nearest(points, k)
    # k neighbour places: copies of the row itself first, then the nearest others with their copies
    places = F.slice(
        F.concat(
            F.array_repeat(F.col("vid"), F.least(F.col("n") - 1, F.lit(k)).cast("int")),
            F.flatten(
                F.transform(
                    F.coalesce("near", F.array().cast("array<struct<dist:double,nvid:string,n:bigint>>")),
                    lambda x: F.array_repeat(x["nvid"], F.least(x["n"], F.lit(k)).cast("int")),
                )
            ),
        ),
        1,
        k,
    )
    # several steps read the result, which would search again
    placed = cut(points.join(near, "vid", "left").select("vid", places.alias("places")))
    bases = order.mark_smallest(minority, {0: extra}, None, key, seed, "one_more")
    copies = (
        bases.withColumn("copies", F.lit(each) + F.col("one_more").cast("int"))
        .where("copies > 0")
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
        .drop("copies", "one_more")
    )
    pick = F.pmod(hash32([*key, "copy"], seed), F.size("places")).cast("int") + 1
    chosen = (
        copies.join(placed, "vid")
        .withColumn("nvid", F.when(F.size("places") > 0, F.element_at("places", pick)).otherwise(F.col("vid")))
        .join(points.select(F.col("vid").alias("nvid"), F.col("vec").alias("mate")), "nvid")
    )
    step = uniform([*key, "copy"], seed + 1)
    synthetic = chosen.select(
        *key,
        *[(F.col(c) + step * (F.col("mate")[i] - F.col(c))).alias(c) for i, c in enumerate(features)],
        F.lit(low).cast(df.schema[label].dataType).alias(label),
        "copy",
    )
    return original.unionByName(synthetic)


def smote_undersample(
    df: DataFrame,
    key: Sequence[str],
    label: str = "class",
    features: Sequence[str] | None = None,
    smote_ratio: float = 0.1,
    under_ratio: float = 0.5,
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """``smote`` to the first ratio, then ``undersample`` to the second."""
    grown = smote(df, key, label, features, smote_ratio, k, seed)
    return undersample(grown, [*key, "copy"], label, under_ratio, seed)


@dataclass
class Preprocessing:
    """A scaler and an optional resampler. ``params`` is the fitted scaler, None before the fit."""

    scaler: str = "standard"
    resampling: str | None = None
    seed: int = 42
    params: DataFrame | None = None

    def __post_init__(self) -> None:
        if self.scaler not in scale.KINDS:
            raise ValueError(f"Invalid scaler: {self.scaler}. Must be one of {list(scale.KINDS)}")
        if self.resampling not in STRATEGIES:
            raise ValueError(f"Invalid resampling: {self.resampling}. Must be one of {list(STRATEGIES)}")

    def fit_train(
        self, df: DataFrame, key: Sequence[str], features: Sequence[str], label: str = "class"
    ) -> DataFrame:
        """Fit the scaler on the training table, scale it, and resample it."""
        self.params = scale.fit(df, features, self.scaler)
        scaled = scale.apply(df.select(*key, *features, label), self.params)
        if self.resampling == "smote":
            return smote(scaled, key, label, features, 1.0, seed=self.seed)
        if self.resampling == "undersample":
            return undersample(scaled, key, label, 1.0, self.seed)
        if self.resampling == "smote_undersample":
            return smote_undersample(scaled, key, label, features, 1.0, 1.0, seed=self.seed)
        return scaled

    def transform(self, df: DataFrame) -> DataFrame:
        """Scale only, with the fitted parameters; test rows are never resampled."""
        return scale.apply(df, self.params)
