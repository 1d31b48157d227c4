"""Feature importance, its comparison, case studies, risk rules."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from riskframe.functions.scalar import contains_any

# Keyword rules on feature names; the first rule that matches decides. Fixed values.
TIME_WORDS = ("time", "hour", "minute", "signup", "purchase")
SIGNUP_WORDS = ("signup", "time_since")
TIMING_WORDS = ("purchase", "transaction")
OTHER_RULES = (
    ("amount", "HIGH", ("amount", "value", "price", "cost")),
    ("device", "MEDIUM", ("device", "browser", "os", "platform")),
    ("location", "MEDIUM", ("ip", "location", "country", "city", "geo")),
    ("velocity", "HIGH", ("freq", "count", "velocity", "rate", "per")),
    ("behaviour", "MEDIUM", ("user", "session", "login", "activity")),
)
GENERAL_RULES = (
    ("Multiple", "multi_factor", "HIGH"),
    ("Model Monitoring", "monitoring", "MEDIUM"),
    ("Explainability", "explainability", "MEDIUM"),
)
RANK_GAP = 3


def importance(model: PipelineModel, features: Sequence[str], method: str = "auto") -> DataFrame:
    """(feature, importance), greatest first: tree importances or absolute coefficients."""
    last = model.stages[-1]
    trees, linear = hasattr(last, "featureImportances"), hasattr(last, "coefficients")
    if method not in ("auto", "builtin", "coefficients"):
        raise ValueError(f"Invalid method: {method}. Must be 'auto', 'builtin' or 'coefficients'")
    if (method == "builtin" and not trees) or (method == "coefficients" and not linear) or not (trees or linear):
        raise ValueError(f"Model does not support importance by method '{method}'")
    if trees and method != "coefficients":
        values = [float(v) for v in last.featureImportances.toArray()]
    else:
        values = [abs(float(v)) for v in last.coefficients]
    names = list(features) if len(features) == len(values) else [f"feature_{i}" for i in range(len(values))]
    rows = list(zip(names, values))
    df = SparkSession.active().createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature")


def global_importance(phi: DataFrame) -> DataFrame:
    """(feature, shap_importance): mean absolute phi."""
    return phi.groupBy("feature").agg(F.avg(F.abs("phi")).alias("shap_importance"))


def compare(builtin: DataFrame, shap: DataFrame) -> DataFrame:
    """Both importances, their ranks, max-normalised values and differences; one row per feature."""
    every = Window.partitionBy(F.lit(0))

    def ranked(df: DataFrame, value: str, rank: str) -> DataFrame:
        return df.withColumn(rank, F.row_number().over(every.orderBy(F.desc(value), "feature")))

    left = ranked(builtin.select("feature", F.col("importance").alias("builtin_importance")), "builtin_importance", "builtin_rank")
    right = ranked(shap.select("feature", "shap_importance"), "shap_importance", "shap_rank")
    both = left.join(right, "feature", "full").na.fill(0)

    def normalised(c: str):
        top = F.max(c).over(every)
        return F.when(top > 0, F.col(c) / top).otherwise(0.0)

    return (
        both.withColumn("rank_difference", F.col("builtin_rank") - F.col("shap_rank"))
        .withColumn("builtin_importance_norm", normalised("builtin_importance"))
        .withColumn("shap_importance_norm", normalised("shap_importance"))
        .withColumn("importance_difference", F.col("builtin_importance_norm") - F.col("shap_importance_norm"))
        .withColumn("avg_rank", (F.col("builtin_rank") + F.col("shap_rank")) / 2)
    )


def top_drivers(comparison: DataFrame, top_n: int = 5, method: str = "combined") -> DataFrame:
    """The top_n features by built-in, shap or average rank, with their place."""
    by = {"builtin": "builtin_rank", "shap": "shap_rank"}.get(method, "avg_rank")
    top = comparison.orderBy(by, "avg_rank", "feature").limit(top_n)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(by, "avg_rank", "feature"))
    return top.withColumn("place", place).select(
        "place", "feature", "builtin_importance", "shap_importance", "builtin_rank", "shap_rank", "rank_difference"
    )


def surprising(comparison: DataFrame, rank_threshold: int = 5, importance_diff_threshold: float = 0.2) -> DataFrame:
    """(finding, feature, ranks, magnitude): one row per finding of a feature, largest first."""
    gap, diff = F.abs("rank_difference"), F.abs("importance_difference")
    b, s = F.col("builtin_rank"), F.col("shap_rank")
    tags = [
        (gap >= rank_threshold, "high_rank_difference", gap.cast("double")),
        (diff >= importance_diff_threshold, "importance_mismatch", diff),
        ((s < b) & (gap >= RANK_GAP), "shap_higher", gap.cast("double")),
        ((b < s) & (gap >= RANK_GAP), "builtin_higher", gap.cast("double")),
    ]
    found = F.array(
        *[F.when(cond, F.struct(F.lit(name).alias("finding"), size.alias("magnitude"))) for cond, name, size in tags]
    )
    return (
        comparison.withColumn("f", F.explode(F.array_compact(found)))
        .select("f.finding", "feature", "builtin_rank", "shap_rank", "avg_rank", "f.magnitude")
        .orderBy("finding", F.desc("magnitude"), "feature")
    )


def case_studies(
    df: DataFrame, key: str, n: int = 1, label: str = "class", prediction: str = "prediction", score: str = "score"
) -> DataFrame:
    """The first n rows (by key) of each of TP, FP, FN; a type with fewer than n rows is left out.

    The row limit is pushed below the shuffle, so a type may have any number of rows.
    """
    if n < 1:
        raise ValueError(f"n must be at least 1. Got {n}")
    y, p = F.col(label), F.col(prediction)
    kind = F.when((p == 1) & (y == 1), "TP").when((p == 1) & (y == 0), "FP").when((p == 0) & (y == 1), "FN")
    place = F.row_number().over(Window.partitionBy("case_type").orderBy(key))
    first = (
        df.select(key, kind.alias("case_type"), p.alias("prediction"), y.alias("actual"), F.col(score).alias("probability"))
        .where(F.col("case_type").isNotNull())
        .withColumn("place", place)
        .where(F.col("place") <= n)
    )
    return first.withColumn("n__", F.count(F.lit(1)).over(Window.partitionBy("case_type"))).where(F.col("n__") >= n).drop("n__")


def case_contributions(cases: DataFrame, phi: DataFrame, key: str) -> DataFrame:
    """Contributions of each case, ordered by size: (key, case_type, place, feature, value, phi)."""
    joined = phi.join(cases.select(key, "case_type", "probability"), key)
    place = F.row_number().over(Window.partitionBy(key).orderBy(F.desc(F.abs("phi")), "feature"))
    cols = [key, "case_type", "probability", "place", "feature", "value", "phi"]
    return joined.withColumn("place", place).select(*cols, *[c for c in ("base_value",) if c in phi.columns])


def attribution_summary(phi: DataFrame, max_display: int = 10) -> DataFrame:
    """Rows of phi for the features of greatest mean absolute phi, with the feature's place."""
    ordered = global_importance(phi).orderBy(F.desc("shap_importance"), "feature").limit(max_display)
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("shap_importance"), "feature"))
    return phi.join(F.broadcast(ordered.withColumn("place", place)), "feature")


def risk_rules(drivers: DataFrame, findings: DataFrame, min_rules: int = 3) -> DataFrame:
    """(feature, category, priority): rule per driver, the top two undervalued features, general fill-ups."""
    name = "feature"
    is_time = contains_any(name, TIME_WORDS)
    time_rule = F.when(contains_any(name, SIGNUP_WORDS), "signup_time").when(contains_any(name, TIMING_WORDS), "purchase_time")
    category = F.when(is_time, time_rule)
    priority = F.when(is_time, F.when(time_rule.isNotNull(), "HIGH"))
    for cat, level, words in OTHER_RULES:
        category = category.when(contains_any(name, words), cat)
        priority = priority.when(contains_any(name, words), level)
    from_drivers = drivers.select(name, category.alias("category"), priority.alias("priority")).where("category is not null")
    undervalued = (
        findings.where("finding = 'shap_higher'")
        .orderBy("avg_rank", name)
        .limit(2)
        .select(name, F.lit("investigate").alias("category"), F.lit("MEDIUM").alias("priority"))
    )
    found = from_drivers.unionByName(undervalued)
    general = drivers.sparkSession.createDataFrame(
        [(i, *r) for i, r in enumerate(GENERAL_RULES)], "i int, feature string, category string, priority string"
    )
    missing = F.lit(min_rules) - found.agg(F.count(F.lit(1))).scalar()
    filler = general.where(F.col("i") < missing).drop("i")
    urgency = F.when(F.col("priority") == "HIGH", 0).when(F.col("priority") == "MEDIUM", 1).otherwise(2)
    return found.unionByName(filler).orderBy(urgency, "feature", "category")


def priority_counts(rules: DataFrame) -> DataFrame:
    return rules.groupBy("priority").agg(F.count(F.lit(1)).alias("n"))


@dataclass
class Interpretation:
    shap_importance: DataFrame
    comparison: DataFrame
    drivers: DataFrame
    findings: DataFrame
    rules: DataFrame


def interpretation(builtin: DataFrame, phi: DataFrame, top_n: int = 5) -> Interpretation:
    """Global importance, comparison, drivers, findings and risk rules in one call."""
    shap = global_importance(phi)
    comparison = compare(builtin, shap)
    drivers = top_drivers(comparison, top_n)
    findings = surprising(comparison)
    return Interpretation(shap, comparison, drivers, findings, risk_rules(drivers, findings))
