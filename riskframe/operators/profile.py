"""Group-by risk profiles, distributions, summaries, correlations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.scalar import right_closed_bin
from riskframe.operators import order
from riskframe.operators.lineage import cut

# Thresholds of the imbalance ratio, highest first. Fixed values.
SEVERITY = {
    "banking": ((100, "EXTREME"), (10, "SEVERE"), (5, "MODERATE")),
    "ecommerce": ((10, "SEVERE"), (5, "MODERATE")),
}
# Groups whose fitted numbers are broadcast; with more of them they are joined by a shuffle.
MAX_FITTED_ROWS = 100_000


def fitted(df: DataFrame, limit: int = MAX_FITTED_ROWS) -> DataFrame:
    """A fitted table, computed once; it is broadcast when it has at most ``limit`` rows."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        return cut(df)
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


def long_values(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by, column_name, value): numeric columns unpivoted, nulls left out."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in cols]
    return (
        df.select(*by, F.explode(F.array(*pairs)).alias("p"))
        .select(*by, "p.*")
        .where(F.col("value").isNotNull())
    )


def column_aggregates(df: DataFrame, cols: Sequence[str], by: Sequence[str], measures: dict) -> DataFrame:
    """(by, column_name, measures): all columns in one wide aggregate, turned to rows afterwards.

    ``measures`` maps a name to a function of a column.
    """
    wide = df.groupBy(*by).agg(
        *[fn(F.col(c).cast("double")).alias(f"{c}__{m}") for c in cols for m, fn in measures.items()]
    )
    rows = [
        F.struct(F.lit(c).alias("column_name"), *[F.col(f"{c}__{m}").alias(m) for m in measures]) for c in cols
    ]
    return wide.select(*by, F.inline(F.array(*rows)))


def group_risk(
    df: DataFrame, key: str, label: str = "class", min_rows: int = 0, percent: bool = False
) -> DataFrame:
    """(key, total_transactions, fraud_count, fraud_rate), riskiest first; null keys are left out."""
    rate = F.avg(label) * (100 if percent else 1)
    out = (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.count(label).alias("total_transactions"),
            F.sum(label).alias("fraud_count"),
            rate.alias("fraud_rate"),
        )
    )
    if min_rows:
        out = out.where(F.col("total_transactions") >= min_rows)
    return out.orderBy(F.desc("fraud_rate"), F.desc("total_transactions"), key)


def overall_rate(df: DataFrame, label: str = "class") -> Column:
    """The label mean of the whole table, as a scalar subquery."""
    return df.agg(F.avg(label)).scalar()


def imbalance(n0: Column, n1: Column) -> Column:
    return F.when(n1 > 0, n0 / n1).otherwise(F.lit(0.0))


def severity(ratio: Column, dataset: str = "ecommerce") -> Column:
    out = F.when(F.lit(False), F.lit(""))
    for limit, name in SEVERITY[dataset]:
        out = out.when(ratio > limit, name)
    return out.otherwise("BALANCED")


def label_distribution(df: DataFrame, label: str = "class", dataset: str = "ecommerce") -> DataFrame:
    """One row: counts and percents of both labels, imbalance ratio n0/n1, severity."""
    n = F.count(label)
    n0, n1 = F.count_if(F.col(label) == 0), F.count_if(F.col(label) == 1)
    ratio = imbalance(n0, n1)
    return df.agg(
        n0.alias("normal_count"),
        n1.alias("fraud_count"),
        (n0 / n * 100).alias("normal_percent"),
        (n1 / n * 100).alias("fraud_percent"),
        ratio.alias("imbalance_ratio"),
        severity(ratio, dataset).alias("severity"),
    )


def compare_distributions(tables: dict[str, tuple[DataFrame, str, str]]) -> DataFrame:
    """Label distributions side by side; values are (table, label column, dataset kind)."""
    parts = [
        label_distribution(df, label, kind).select(F.lit(name).alias("dataset"), "*")
        for name, (df, label, kind) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def distribution_change(before: DataFrame, after: DataFrame, label: str = "class") -> DataFrame:
    """Per label: count and percent before and after, and the change of the count."""

    def counts(df: DataFrame, name: str) -> DataFrame:
        total = df.agg(F.count(label)).scalar()
        return (
            df.groupBy(label)
            .agg(F.count(F.lit(1)).alias(f"count_{name}"))
            .withColumn(f"percent_{name}", F.col(f"count_{name}") / total * 100)
        )

    return (
        counts(before, "before")
        .join(counts(after, "after"), label, "full")
        .na.fill(0)
        .withColumn("change", F.col("count_after") - F.col("count_before"))
    )


def value_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, value, n) of categorical columns, most frequent first; nulls left out."""
    pairs = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in cols]
    return (
        df.select(F.explode(F.array(*pairs)).alias("p"))
        .select("p.*")
        .where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("column_name", F.desc("n"), "value")
    )


def distinct_counts(df: DataFrame, cols: Sequence[str], approx: bool = False) -> DataFrame:
    """(column_name, n_distinct); ``approx`` uses a constant-size sketch."""
    fn = F.approx_count_distinct if approx else F.count_distinct
    wide = df.agg(*[fn(c).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_distinct")) for c in cols])
    return wide.select(F.inline(pairs))


def crosstab(df: DataFrame, key: str, label: str = "class", labels: Sequence[int] = (0, 1)) -> DataFrame:
    """Counts per key and label, and their share of the key's rows in percent."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.count_if(F.col(label) == v).alias(f"n_{v}") for v in labels], F.count(label).alias("n_total")
    )
    return counts.select("*", *[(F.col(f"n_{v}") / F.col("n_total") * 100).alias(f"pct_{v}") for v in labels])


def correlations(df: DataFrame, cols: Sequence[str], against: Sequence[str] | None = None) -> DataFrame:
    """(feature_a, feature_b, correlation) for all pairs, or against the given columns, in one aggregate."""
    against = list(against) if against is not None else list(cols)
    pairs = {}
    for a in cols:
        for b in against:
            pairs.setdefault(tuple(sorted((a, b))), f"p{len(pairs)}")
    wide = df.agg(*[F.corr(F.col(a), F.col(b)).alias(name) for (a, b), name in pairs.items()])
    rows = [
        F.struct(
            F.lit(a).alias("feature_a"),
            F.lit(b).alias("feature_b"),
            F.col(pairs[tuple(sorted((a, b)))]).alias("correlation"),
        )
        for a in cols
        for b in against
    ]
    return wide.select(F.inline(F.array(*rows)))


def top_correlated(df: DataFrame, cols: Sequence[str], label: str, k: int = 10) -> DataFrame:
    """The k features with the greatest absolute correlation with the label."""
    return (
        correlations(df, cols, [label])
        .select(F.col("feature_a").alias("feature"), "correlation", F.abs("correlation").alias("abs_correlation"))
        .orderBy(F.desc_nulls_last("abs_correlation"), "feature")
        .limit(k)
    )


def top_correlation_matrix(df: DataFrame, cols: Sequence[str], label: str, k: int = 10) -> DataFrame:
    """Correlation matrix of the k features most correlated with the label, and the label itself."""
    names = [r["feature"] for r in top_correlated(df, cols, label, k).collect()]
    return correlations(df, [*names, label])


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """(by, column_name, count, mean, std, min, q25, q50, q75, max) with the sample deviation.

    Quantiles are exact and interpolated; ``approx`` takes them from a sketch in the same pass.
    """
    probs = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    kept = df if not by else df.dropna(subset=list(by))
    measures = {"count": F.count, "mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}
    if approx:
        measures |= {name: (lambda c, p=p: F.percentile_approx(c, F.lit(p))) for name, p in probs.items()}
    out = column_aggregates(kept, cols, by, measures)
    if not approx:
        out = out.join(order.quantiles(kept, cols, probs, by), [*by, "column_name"], "left")
    return out.select(*by, "column_name", "count", "mean", "std", "min", *probs, "max")


def describe_text(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column_name, count, n_distinct, top, freq) of text columns."""
    counts = df.agg(*[F.count(c).alias(c) for c in cols])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("count")) for c in cols])
    return counts.select(F.inline(pairs)).join(order.modes(df, cols), "column_name", "left")


def mean_median_by_label(df: DataFrame, cols: Sequence[str], label: str = "class") -> DataFrame:
    """(label, column_name, mean, median)."""
    means = column_aggregates(df.dropna(subset=[label]), cols, [label], {"mean": F.avg})
    return means.join(order.quantiles(df, cols, {"median": 0.5}, [label]), [label, "column_name"])


def histogram(df: DataFrame, cols: dict[str, int], by: Sequence[str] = ()) -> DataFrame:
    """Equal-width histogram: (by, column_name, bin, bin_low, bin_high, n), empty bins included.

    ``cols`` gives the number of bins per column. With ``by`` every group has its own
    range. The last bin is closed; a constant column gets the range value +- 0.5.
    """
    values = long_values(df, list(cols), by)
    bins = F.lit(None).cast("int")
    for c, n in cols.items():
        bins = F.when(F.col("column_name") == c, F.lit(n)).otherwise(bins)
    flat = F.min("value") == F.max("value")
    ranges = fitted(
        values.groupBy(*by, "column_name").agg(
            F.when(flat, F.min("value") - 0.5).otherwise(F.min("value")).alias("lo"),
            F.when(flat, F.max("value") + 0.5).otherwise(F.max("value")).alias("hi"),
        )
    ).withColumn("bins", bins)
    keys = [*by, "column_name"]
    index = F.least(
        F.floor((F.col("value") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.col("bins")), F.col("bins") - 1
    )
    counts = (
        values.join(ranges, keys)
        .groupBy(*keys, index.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    width = (F.col("hi") - F.col("lo")) / F.col("bins")
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)))
    return grid.join(counts, [*keys, "bin"], "left").select(
        *keys,
        "bin",
        (F.col("lo") + width * F.col("bin")).alias("bin_low"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Quartiles, whiskers at the last value within 1.5 IQR, and the number of outliers."""
    keys = [*by, "column_name"]
    quartiles = fitted(order.quantiles(df, cols, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by))
    iqr = F.col("q3") - F.col("q1")
    inside = (F.col("value") >= F.col("q1") - 1.5 * iqr) & (F.col("value") <= F.col("q3") + 1.5 * iqr)
    return (
        long_values(df, cols, by)
        .join(quartiles, keys)
        .groupBy(*keys, "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
        )
    )


def rate_by_bin(df: DataFrame, hours: str = "time_since_signup", label: str = "class") -> DataFrame:
    """Fraud rate in percent per bin of hours since signup; values outside all bins are left out."""
    return group_risk(df.withColumn("time_bin", right_closed_bin(hours)), "time_bin", label, percent=True)


def top_groups(
    df: DataFrame, key: str, n: int, order_by: str, label: str = "class", min_rows: int = 0, ascending: bool = False
) -> DataFrame:
    """The first n groups of ``group_risk`` (rates in percent) by rate, fraud count or volume."""
    edge = F.asc(order_by) if ascending else F.desc(order_by)
    return group_risk(df, key, label, min_rows, percent=True).orderBy(edge, key).limit(n)


def geo_risk(
    df: DataFrame, key: str = "country", label: str = "class", min_rows: int = 100
) -> DataFrame:
    """Groups with enough rows whose rate is far from the overall rate, with ratio and level.

    CRITICAL above 3x, HIGH above 2x, LOW below 0.5x the overall rate.
    """
    ratio = F.col("fraud_rate") / (overall_rate(df, label) * 100)
    level = (
        F.when(F.col("risk_ratio") > 3, "CRITICAL")
        .when(F.col("risk_ratio") > 2, "HIGH")
        .when(F.col("risk_ratio") < 0.5, "LOW")
    )
    return (
        group_risk(df, key, label, min_rows, percent=True)
        .withColumn("risk_ratio", ratio)
        .withColumn("risk_level", level)
        .where(F.col("risk_level").isNotNull())
    )
