"""Bivariate risk findings: amount, device, source, browser, and the rank-sum test."""

from __future__ import annotations

import math
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.scalar import safe_ratio
from riskframe.operators import order
from riskframe.operators.clean import require_columns
from riskframe.operators.profile import group_risk

# Thresholds on the ratio to the overall rate: (CRITICAL, HIGH, elevated). Fixed values.
KEY_LEVELS = {"device": (3.0, 2.0, 1.5), "source": (3.0, 2.0, 1.5), "browser": (2.5, 1.8, 1.5)}
AMOUNT_LEVELS = (1.5, 1.2)
DEVICE_MIN_ROWS = 5


@F.pandas_udf(T.DoubleType())
def two_sided_p(z: pd.Series) -> pd.Series:
    """Two-sided normal tail of z; runs on one row per test."""
    return z.map(lambda v: None if v is None or math.isnan(v) else min(1.0, math.erfc(v / math.sqrt(2.0))))


def mann_whitney(df: DataFrame, value: str, label: str = "class", p_value: bool = True) -> DataFrame:
    """Two-sided rank-sum test of label 1 against label 0 (normal approximation, ties corrected).

    One row: n1, n0, u_statistic (of label 1), z, p_value. Ranks come from counts per
    distinct value, so equal values cost one row and no task sorts the table.
    """
    require_columns(df, [value, label])
    counts = order.value_counts_long(
        df.where(F.col(label).isin(0, 1)), [value], sums={"pos": F.col(label).cast("bigint")}
    )
    placed = order.add_preceding(counts, ["column_name"], "cell", "value", ["n"])
    n, pos = F.col("n").cast("double"), F.col("pos").cast("double")
    mean_rank = F.col("n_before") + (n + 1) / 2
    sums = placed.agg(
        F.sum("pos").alias("n1"),
        (F.sum("n") - F.sum("pos")).alias("n0"),
        F.sum(pos * mean_rank).alias("r1"),
        F.sum(n * n * n - n).alias("ties"),
    )
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    total = n1 + n0
    u = F.col("r1") - n1 * (n1 + 1) / 2
    sigma = F.sqrt(n1 * n0 / 12 * ((total + 1) - F.col("ties") / (total * (total - 1))))
    out = sums.select(
        "n1",
        "n0",
        u.alias("u_statistic"),
        F.when(sigma > 0, (F.greatest(u, n1 * n0 - u) - n1 * n0 / 2 - 0.5) / sigma).alias("z"),
    )
    return out.withColumn("p_value", two_sided_p("z")) if p_value else out


def amount(df: DataFrame, value: str = "purchase_value", label: str = "class") -> DataFrame:
    """One row: means and medians by label, ratio of the means, risk level."""
    require_columns(df, [value, label])
    is1, is0 = F.col(label) == 1, F.col(label) == 0
    means = df.agg(
        F.avg(F.when(is1, F.col(value))).alias("fraud_mean"), F.avg(F.when(is0, F.col(value))).alias("normal_mean")
    )
    by_label = order.quantiles(df, [value], {"median": 0.5}, [label])
    medians = by_label.agg(
        F.max(F.when(is1, F.col("median"))).alias("fraud_median"),
        F.max(F.when(is0, F.col("median"))).alias("normal_median"),
    )
    high, moderate = AMOUNT_LEVELS
    level = (
        F.when(F.col("risk_ratio") > high, "HIGH").when(F.col("risk_ratio") > moderate, "MODERATE").otherwise("LOW")
    )
    return (
        means.select(
            "*",
            medians.select("fraud_median").scalar().alias("fraud_median"),
            medians.select("normal_median").scalar().alias("normal_median"),
        )
        .withColumn("risk_ratio", safe_ratio("fraud_mean", "normal_mean"))
        .withColumn("risk_level", level)
    )


def _rates(df: DataFrame, key: str, label: str, min_rows: int) -> tuple[DataFrame, Column]:
    require_columns(df, [key, label])
    return group_risk(df, key, label, min_rows), df.agg(F.avg(label)).scalar()


def key_groups(
    df: DataFrame, key: str, label: str = "class", min_rows: int = 0, kind: str = "source", top_n: int | None = None
) -> DataFrame:
    """Groups above 1.5x the overall rate with their ratio, riskiest first; ``top_n`` is the report length."""
    groups, overall = _rates(df, key, label, min_rows)
    out = (
        groups.withColumn("overall_fraud_rate", overall)
        .where(F.col("fraud_rate") > F.col("overall_fraud_rate") * KEY_LEVELS[kind][2])
        .withColumn("risk_ratio", F.col("fraud_rate") / F.col("overall_fraud_rate"))
        .orderBy(F.desc("fraud_rate"), F.desc("total_transactions"), key)
    )
    return out.limit(top_n) if top_n else out


def by_key(
    df: DataFrame, key: str, label: str = "class", kind: str = "source", min_rows: int = 0, top_n: int | None = None
) -> DataFrame:
    """One row: overall rate, number of elevated groups, greatest rate and its key, risk level.

    All elevated groups are counted. ``top_n`` marks a report of the elevated groups only: its
    greatest rate is 0 when no group is elevated.
    """
    critical, high, elevated = KEY_LEVELS[kind]
    groups, overall = _rates(df, key, label, min_rows)
    above = F.col("fraud_rate") > F.col("overall") * elevated
    found = groups.withColumn("overall", overall).agg(
        F.max("overall").alias("overall_fraud_rate"),
        F.count_if(above).alias("high_risk_count"),
        F.max("fraud_rate").alias("top_rate"),
    )
    n_high = F.col("high_risk_count")
    rate = F.when(n_high > 0, F.col("top_rate")).otherwise(0.0) if top_n else F.col("top_rate")
    level = (
        F.when(n_high == 0, "LOW")
        .when(F.col("top_rate") > F.col("overall_fraud_rate") * critical, "CRITICAL")
        .when(F.col("top_rate") > F.col("overall_fraud_rate") * high, "HIGH")
        .otherwise("MODERATE")
    )
    return found.select(
        "overall_fraud_rate", "high_risk_count", rate.alias("max_fraud_rate"), level.alias("risk_level")
    )


def device(df: DataFrame, key: str = "device_id", label: str = "class", top_n: int = 10) -> DataFrame:
    return by_key(df, key, label, "device", DEVICE_MIN_ROWS, top_n)


def source(df: DataFrame, key: str = "source", label: str = "class") -> DataFrame:
    return by_key(df, key, label, "source")


def browser(df: DataFrame, key: str = "browser", label: str = "class") -> DataFrame:
    return by_key(df, key, label, "browser")


def summary(
    df: DataFrame,
    amount_col: str = "purchase_value",
    device_col: str = "device_id",
    source_col: str = "source",
    browser_col: str = "browser",
    label: str = "class",
) -> DataFrame:
    """Four findings with level and priority flag, each beside the totals of the table."""
    parts = {
        "amount": amount(df, amount_col, label).select(F.col("risk_ratio").alias("measure"), "risk_level"),
        "device": device(df, device_col, label).select(F.col("max_fraud_rate").alias("measure"), "risk_level"),
        "source": source(df, source_col, label).select(F.col("max_fraud_rate").alias("measure"), "risk_level"),
        "browser": browser(df, browser_col, label).select(F.col("max_fraud_rate").alias("measure"), "risk_level"),
    }
    findings = reduce(
        DataFrame.unionByName, [p.select(F.lit(name).alias("factor"), "*") for name, p in parts.items()]
    )
    totals = df.agg(
        F.struct(
            F.avg(label).alias("rate"),
            F.count(F.lit(1)).alias("n"),
            F.sum(label).alias("n1"),
            F.count_if(F.col(label) == 0).alias("n0"),
        )
    ).scalar()
    return findings.withColumn("t", totals).select(
        "factor",
        "measure",
        "risk_level",
        F.col("risk_level").isin("CRITICAL", "HIGH").alias("is_priority"),
        F.col("t.rate").alias("overall_fraud_rate"),
        F.col("t.n").alias("total_transactions"),
        F.col("t.n1").alias("fraud_cases"),
        F.col("t.n0").alias("normal_cases"),
    )
