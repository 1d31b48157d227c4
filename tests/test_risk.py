import itertools
import math

import pytest
from pyspark.sql import functions as F

from riskframe.operators import profile, risk


def test_group_risk_drops_null_keys_and_labels(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("a", None), (None, 1), ("b", 0)], "k string, class int")
    got = [tuple(r) for r in profile.group_risk(df, "k").collect()]
    assert got == [("a", 2, 1, 0.5), ("b", 1, 0, 0.0)]


def test_label_distribution_without_fraud(spark):
    r = profile.label_distribution(spark.range(4).select(F.lit(0).alias("class"))).first()
    assert (r["imbalance_ratio"], r["severity"]) == (0.0, "BALANCED")


@pytest.mark.parametrize("n0,kind,want", [(101, "banking", "EXTREME"), (100, "banking", "SEVERE"), (101, "ecommerce", "SEVERE"), (6, "banking", "MODERATE"), (5, "ecommerce", "BALANCED")])
def test_severity(spark, n0, kind, want):
    df = spark.range(n0 + 1).select((F.col("id") == 0).cast("int").alias("class"))
    assert profile.label_distribution(df, dataset=kind).first()["severity"] == want


def test_histogram_counts_every_row(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 4, 10, 10]], "x double")
    got = [(r["bin"], r["n"]) for r in profile.histogram(df, {"x": 5}).orderBy("bin").collect()]
    assert got == [(0, 2), (1, 2), (2, 1), (3, 0), (4, 2)]
    flat = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert [(r["n"]) for r in profile.histogram(flat, {"x": 2}).orderBy("bin").collect()] == [0, 2]


def test_many_fitted_groups_are_kept(spark):
    assert sorted(r[0] for r in profile.fitted(spark.range(10), 3).collect()) == list(range(10))


def brute_u(xs, ys):
    return sum((x > y) + 0.5 * (x == y) for x, y in itertools.product(xs, ys))


def test_mann_whitney(spark):
    xs, ys = [1.0, 2.0, 2.0, 5.0, 9.0], [2.0, 3.0, 3.0, 4.0, 0.5, 1.0, 1.0]
    df = spark.createDataFrame([(v, 1) for v in xs] + [(v, 0) for v in ys] + [(None, 1)], "v double, class int")
    r = risk.mann_whitney(df, "v").first()
    assert (r["n1"], r["n0"], r["u_statistic"]) == (5, 7, brute_u(xs, ys))
    n, every = 12, xs + ys
    ties = sum(every.count(v) ** 3 - every.count(v) for v in set(every))
    sigma = math.sqrt(35 / 12 * (13 - ties / (n * (n - 1))))
    z = (max(r["u_statistic"], 35 - r["u_statistic"]) - 17.5 - 0.5) / sigma
    assert r["z"] == pytest.approx(z)
    assert r["p_value"] == pytest.approx(min(1.0, math.erfc(z / math.sqrt(2))))


def test_amount_levels(spark):
    def level(fraud, normal):
        df = spark.createDataFrame([(float(fraud), 1), (float(normal), 0)], "purchase_value double, class int")
        return risk.amount(df).first()["risk_level"]

    assert [level(f, 10) for f in (15.1, 15, 12.1, 12, 1)] == ["HIGH", "MODERATE", "MODERATE", "LOW", "LOW"]
    assert level(5, 0) == "LOW"


def keyed(spark, rates, rows=20):
    data = [(k, int(i < rate * rows)) for k, rate in rates.items() for i in range(rows)]
    return spark.createDataFrame(data, "k string, class int")


def test_key_levels(spark):
    low = risk.source(keyed(spark, {"a": 0.1, "b": 0.1}), "k").first()
    assert (low["risk_level"], low["high_risk_count"], low["max_fraud_rate"]) == ("LOW", 0, 0.1)
    calm = risk.device(keyed(spark, {"a": 0.1, "b": 0.1}), "k").first()
    assert (calm["risk_level"], calm["max_fraud_rate"]) == ("LOW", 0.0)
    spike = {"a": 0.5, **{f"n{i}": 0.05 for i in range(9)}}
    hot = risk.source(keyed(spark, spike), "k").first()
    assert (hot["risk_level"], hot["high_risk_count"]) == ("CRITICAL", 1)
    mid = {"a": 0.3, "b": 0.1, "c": 0.1}
    assert risk.source(keyed(spark, mid), "k").first()["risk_level"] == "MODERATE"


def test_device_report_counts_all_risky_devices(spark):
    rates = {f"h{i}": 0.5 for i in range(5)} | {f"n{i}": 0.0 for i in range(15)}
    df = keyed(spark, rates)
    assert risk.device(df, "k", top_n=3).first()["high_risk_count"] == 5
    assert risk.key_groups(df, "k", min_rows=5, kind="device").count() == 5


def test_summary(tx):
    got = {r["factor"]: r for r in risk.summary(tx).collect()}
    assert set(got) == {"amount", "device", "source", "browser"}
    assert got["device"]["is_priority"] == (got["device"]["risk_level"] in ("CRITICAL", "HIGH"))
    assert got["amount"]["fraud_cases"] + got["amount"]["normal_cases"] == got["amount"]["total_transactions"] == tx.count()
