"""Classification metrics on a prediction table (label, prediction, score).

``by`` computes them per group (fold, split, model) in the same pass. ``rows`` names a column that counts the rows a row stands for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.scalar import safe_ratio
from riskframe.operators import order

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")


def _cells(label: str, prediction: str, rows: str | None = None) -> dict[str, Column]:
    y, p = F.col(label), F.col(prediction)
    where = {"tn": (y == 0) & (p == 0), "fp": (y == 0) & (p == 1), "fn": (y == 1) & (p == 0), "tp": (y == 1) & (p == 1)}
    if rows is None:
        return {name: F.count_if(c) for name, c in where.items()}
    return {name: F.coalesce(F.sum(F.when(c, F.col(rows))), F.lit(0)) for name, c in where.items()}


def counts(df: DataFrame, label="class", prediction="prediction", by: Sequence[str] = (), rows: str | None = None) -> DataFrame:
    """(by, tn, fp, fn, tp)."""
    return df.groupBy(*by).agg(*[c.alias(n) for n, c in _cells(label, prediction, rows).items()])


def confusion(df: DataFrame, label="class", prediction="prediction", by: Sequence[str] = ()) -> DataFrame:
    """(by, actual, predicted, n): always all four cells."""
    cells = (("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1))
    rows = [
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(name).alias("n"))
        for name, a, p in cells
    ]
    return counts(df, label, prediction, by).select(*by, F.inline(F.array(*rows)))


def scores(df: DataFrame, label="class", prediction="prediction", by: Sequence[str] = (), rows: str | None = None) -> DataFrame:
    """(by, accuracy, precision, recall, f1) of label 1; a ratio over nothing is 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return counts(df, label, prediction, by, rows).select(
        *by,
        safe_ratio(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        safe_ratio(tp, tp + fp).alias("precision"),
        safe_ratio(tp, tp + fn).alias("recall"),
        safe_ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
    )


def ranking_scores(df: DataFrame, label="class", score="score", by: Sequence[str] = (), rows: str | None = None) -> DataFrame:
    """(by, roc_auc, pr_auc), exact with ties; null where a class is missing.

    Distinct scores are counted first; running counts from the highest score down give
    the area under the ROC curve and the average precision without a global sort.
    """
    positive = F.col(label).cast("bigint")
    if rows is None:
        flipped = df.select(*by, (-F.col(score).cast("double")).alias("key__"), label)
        distinct = order.value_counts_long(flipped, ["key__"], by, {"pos": positive})
    else:
        flipped = df.select(*by, (-F.col(score).cast("double")).alias("key__"), label, rows)
        sums = {"pos": positive * F.col(rows), "rows__": F.col(rows)}
        distinct = order.value_counts_long(flipped, ["key__"], by, sums).drop("n").withColumnRenamed("rows__", "n")
    placed = order.add_preceding(distinct, [*by, "column_name"], "cell", "value", ["n", "pos"])
    pos, n = F.col("pos").cast("double"), F.col("n").cast("double")
    neg = n - pos
    neg_above = (F.col("n_before") - F.col("pos_before")).cast("double")
    sums = placed.groupBy(*by).agg(
        F.sum(pos).alias("p"),
        F.sum(neg).alias("q"),
        F.sum(pos * (neg_above + neg / 2)).alias("lost"),
        F.sum(pos * (F.col("pos_before") + pos) / (F.col("n_before") + n)).alias("gain"),
    )
    return sums.select(
        *by,
        F.when((F.col("p") > 0) & (F.col("q") > 0), 1 - F.col("lost") / (F.col("p") * F.col("q"))).alias("roc_auc"),
        F.when(F.col("p") > 0, F.col("gain") / F.col("p")).alias("pr_auc"),
    )


def roc_auc(df: DataFrame, label="class", score="score", by: Sequence[str] = ()) -> DataFrame:
    return ranking_scores(df, label, score, by).select(*by, "roc_auc")


def average_precision(df: DataFrame, label="class", score="score", by: Sequence[str] = ()) -> DataFrame:
    return ranking_scores(df, label, score, by).select(*by, "pr_auc")


def evaluate(
    df: DataFrame,
    label="class",
    prediction="prediction",
    score="score",
    by: Sequence[str] = (),
    metrics: Sequence[str] | None = None,
    rows: str | None = None,
) -> DataFrame:
    """(by, metric, value) for the wanted metrics; an undefined area is null."""
    names = list(metrics) if metrics is not None else list(METRICS)
    wrong = [m for m in names if m not in METRICS]
    if wrong:
        raise ValueError(f"Invalid metrics: {wrong}; known are {', '.join(METRICS)}")
    flat = scores(df, label, prediction, by, rows)
    if {"roc_auc", "pr_auc"} & set(names):
        areas = ranking_scores(df, label, score, by, rows)
        if by:
            flat = order.null_safe_join(flat, areas, list(by), "left")
        else:
            both = areas.select(F.struct("roc_auc", "pr_auc")).scalar()
            flat = flat.withColumn("a", both).select("*", "a.roc_auc", "a.pr_auc")
    pairs = [F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in names]
    return flat.select(*by, F.inline(F.array(*pairs)))


def report(df: DataFrame, label="class", prediction="prediction", by: Sequence[str] = ()) -> DataFrame:
    """(by, row, precision, recall, f1, support): both classes, accuracy, macro and weighted averages."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def line(name: str, hit: Column, false_hit: Column, miss: Column) -> Column:
        return F.struct(
            F.lit(name).alias("row"),
            safe_ratio(hit, hit + false_hit).alias("precision"),
            safe_ratio(hit, hit + miss).alias("recall"),
            safe_ratio(2 * hit, 2 * hit + false_hit + miss).alias("f1"),
            (hit + miss).alias("support"),
        )

    c = counts(df, label, prediction, by).select(
        *by, line("0", tn, fn, fp).alias("c0"), line("1", tp, fp, fn).alias("c1"), safe_ratio(tp + tn, tp + tn + fp + fn).alias("acc")
    )
    total = F.col("c0.support") + F.col("c1.support")
    measures = ("precision", "recall", "f1")
    macro = [((F.col(f"c0.{m}") + F.col(f"c1.{m}")) / 2).alias(m) for m in measures]
    weighted = [
        safe_ratio(F.col(f"c0.{m}") * F.col("c0.support") + F.col(f"c1.{m}") * F.col("c1.support"), total).alias(m)
        for m in measures
    ]
    return c.select(
        *by,
        F.inline(
            F.array(
                F.col("c0"),
                F.col("c1"),
                F.struct(F.lit("accuracy").alias("row"), *[F.col("acc").alias(m) for m in measures], total.alias("support")),
                F.struct(F.lit("macro avg").alias("row"), *macro, total.alias("support")),
                F.struct(F.lit("weighted avg").alias("row"), *weighted, total.alias("support")),
            )
        ),
    )
