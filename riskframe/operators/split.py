"""Seeded stratified splits, folds and samples that do not depend on the partitioning."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.scalar import uniform
from riskframe.operators import clean, order
from riskframe.operators.lineage import cut


def class_counts(df: DataFrame, label: str) -> dict:
    """Rows per class, for labels with few classes (checked)."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).count()
    rows = counts.limit(order.MAX_CLASSES + 1).collect()
    if len(rows) > order.MAX_CLASSES:
        raise ValueError(f"Label '{label}' has more than {order.MAX_CLASSES} classes")
    return {r[label]: r["count"] for r in rows}


def round_half_up(x: float) -> int:
    return math.floor(x + 0.5)


def stratified(
    df: DataFrame,
    key: Sequence[str],
    label: str = "class",
    test_size: float = 0.2,
    seed: int = 42,
    exact: bool = True,
    stratify: bool = True,
) -> DataFrame:
    """Add ``split`` ('train' or 'test').

    Exact: in each class the round(n * test_size) rows with the smallest key hash are the
    test rows; a class with fewer than 2 rows turns stratification off. Otherwise a row is
    a test row when its uniform number is below ``test_size``: one pass, sizes in
    expectation.
    """
    if not 0 < test_size < 1:
        raise ValueError(f"test_size is {test_size}; it has to lie inside (0, 1)")
    clean.require_columns(df, [*key, label])
    if not exact:
        return df.withColumn("split", F.when(uniform(key, seed) < test_size, "test").otherwise("train"))
    counts = class_counts(df, label)
    if not counts:
        raise ValueError("Dataframe is empty")
    if stratify and df.where(F.col(label).isNull()).limit(1).count():
        raise ValueError(f"Label '{label}' has null values; drop or fill them before a stratified split")
    if stratify and min(counts.values()) >= 2:
        take, by = {c: round_half_up(n * test_size) for c, n in counts.items()}, label
    else:
        take, by = {0: round_half_up(sum(counts.values()) * test_size)}, None
    marked = order.mark_smallest(df, take, by, key, seed, "test__")
    return marked.withColumn("split", F.when(F.col("test__"), "test").otherwise("train")).drop("test__")


@dataclass
class Split:
    """Train and test tables with their class counts; features and label stay in one table."""

    train: DataFrame
    test: DataFrame
    features: list[str]
    target: str
    distribution: DataFrame


def split_distribution(marked: DataFrame, label: str) -> DataFrame:
    """(split, label, n)."""
    return marked.groupBy("split", label).agg(F.count(F.lit(1)).alias("n"))


def prepare_and_split(
    df: DataFrame,
    key: Sequence[str],
    dataset: str = "ecommerce",
    features: Sequence[str] | None = None,
    exclude: Sequence[str] | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    stratify: bool = True,
) -> Split:
    """Choose the features, keep the row key beside them, and split by class.

    The marked table is stored once, since training reads its parts many times.
    """
    conf = clean.DATASETS[dataset]
    dropped = [*(conf["exclude"] if exclude is None else exclude), *key]
    names = clean.feature_columns(df, conf["target"], dropped, features)
    kept = df.select(*key, *[n for n in names if n not in key], conf["target"])
    marked = cut(stratified(kept, key, conf["target"], test_size, seed, stratify=stratify))
    return Split(
        train=marked.where("split = 'train'").drop("split"),
        test=marked.where("split = 'test'").drop("split"),
        features=names,
        target=conf["target"],
        distribution=split_distribution(marked, conf["target"]),
    )


def folds(df: DataFrame, key: Sequence[str], label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` (0..k-1): the rank of the key hash within the class, modulo k; rows without a label are a class."""
    if k < 2:
        raise ValueError(f"n_folds is {k}; two folds are the least")
    ranked = order.hash_rank(df, [label], key, seed, "rank__")
    return ranked.withColumn("fold", ((F.col("rank__") - 1) % k).cast("int")).drop("rank__")


def sample_per_class(df: DataFrame, key: Sequence[str], label: str, caps: dict, seed: int = 42) -> DataFrame:
    """A sample of up to ``caps[class]`` rows of each class: those with the smallest key hash."""
    return order.mark_smallest(df, caps, label, key, seed, "kept__").where("kept__").drop("kept__")


def sample_rows(df: DataFrame, key: Sequence[str], n: int, seed: int = 42) -> DataFrame:
    """A sample of n rows: those with the smallest key hash."""
    return order.mark_smallest(df, {0: n}, None, key, seed, "kept__").where("kept__").drop("kept__")
