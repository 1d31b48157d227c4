import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import attribution, explain, models
from riskframe.sources import canonical

FEATURES = [f"f{i}" for i in range(4)]


@pytest.fixture(scope="module")
def data(spark, sf):
    return canonical.wide_features(spark, sf).cache()


def totals(phi):
    out = phi.groupBy("vec_id").agg((F.sum("phi") + F.first("base_value")).alias("t"))
    return {r["vec_id"]: r["t"] for r in out.collect()}


def scores(model, df):
    return {r["vec_id"]: r["score"] for r in models.predict(model, df).collect()}


@pytest.mark.parametrize("kind", ["random_forest", "xgboost"])
def test_tree_phi_adds_up(data, kind):
    m = models.train(data, kind, FEATURES, "Class", n_estimators=4, max_depth=5)
    got, want = totals(attribution.tree_phi(m, data, ["vec_id"], FEATURES)), scores(m, data)
    assert set(got) == set(want)
    link = (lambda z: z) if kind == "random_forest" else (lambda z: 1 / (1 + math.exp(-2 * z)))
    assert max(abs(link(got[k]) - want[k]) for k in want) < 1e-9


def test_leaf_phi_matches_enumeration(data):
    m = models.train(data, "random_forest", FEATURES, "Class", n_estimators=3, max_depth=4)
    leaves = attribution.leaf_table(m.stages[-1])
    x = np.array([[r[f] for f in FEATURES] for r in data.orderBy("vec_id").limit(6).collect()])

    def game(row, known):
        reached = (row[leaves.feature] > leaves.low) & (row[leaves.feature] <= leaves.high)
        inside = np.isin(leaves.feature, list(known))
        return (leaves.value * np.where(inside, reached, leaves.share).prod(axis=1)).sum()

    want = np.zeros_like(x)
    for a, i in itertools.product(range(len(x)), range(4)):
        others = [j for j in range(4) if j != i]
        for n in range(4):
            weight = math.factorial(n) * math.factorial(3 - n) / math.factorial(4)
            for s in itertools.combinations(others, n):
                want[a, i] += weight * (game(x[a], {*s, i}) - game(x[a], s))
    assert np.allclose(attribution.leaf_phi(x, leaves), want)


def test_linear_phi_adds_up(data):
    weights = {"f0": 2.0, "f1": -1.0}
    got = totals(attribution.linear_phi(data, ["vec_id"], weights, intercept=0.5))
    for r in data.collect():
        assert got[r["vec_id"]] == pytest.approx(0.5 + 2 * r["f0"] - r["f1"])


def test_sampled_phi_adds_up_and_tracks_signs(data):
    m = models.train(data, "logistic_regression", FEATURES, "Class", class_weight=None, C=100.0)
    few = data.where("vec_id < 15")
    phi = attribution.sampled_phi(m, few, ["vec_id"], FEATURES, data, n_permutations=40, n_background=60)
    got, want = totals(phi), scores(m, few)
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9
    exact = attribution.linear_phi(few, ["vec_id"], dict(zip(FEATURES, map(float, m.stages[-1].coefficients))), data)
    both = phi.select("vec_id", "feature", F.col("phi").alias("a")).join(
        exact.select("vec_id", "feature", F.col("phi").alias("b")), ["vec_id", "feature"]
    )
    assert both.agg(F.corr("a", "b")).first()[0] > 0.9


def test_sampled_phi_of_a_line_takes_no_row_per_step(data, monkeypatch):
    m = models.train(data, "logistic_regression", FEATURES, "Class", class_weight=None, C=10.0)
    few = data.where("vec_id < 15")
    few = few.unionByName(few.where("vec_id < 4"))
    args = (m, few, ["vec_id"], FEATURES, data, 7, 30)
    key = lambda r: (r["vec_id"], r["feature"])
    fast = attribution.sampled_phi(*args)
    plan = fast._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1 and "UDF" not in plan
    monkeypatch.setattr(attribution, "_linear_score", lambda *_: None, raising=False)
    plain = sorted(attribution.sampled_phi(*args).collect(), key=key)
    fast = sorted(fast.collect(), key=key)
    assert [key(r) for r in fast] == [key(r) for r in plain]
    for name in ("value", "phi", "base_value"):
        assert [r[name] for r in fast] == pytest.approx([r[name] for r in plain], abs=1e-12)


def test_explain_model_picks_the_method(data):
    lr = models.train(data, "logistic_regression", FEATURES, "Class")
    assert attribution.explain_model(lr, data, ["vec_id"], FEATURES, n_rows=10).count() == 40
    rf = models.train(data, "random_forest", FEATURES, "Class", n_estimators=2, max_depth=2)
    assert attribution.explain_model(rf, data, ["vec_id"], FEATURES, n_rows=7).count() == 28


def test_importance(data):
    rf = models.train(data, "random_forest", FEATURES, "Class", n_estimators=2, max_depth=3)
    rows = explain.importance(rf, FEATURES).collect()
    assert [r["importance"] for r in rows] == sorted([r["importance"] for r in rows], reverse=True)
    assert {r["feature"] for r in explain.importance(rf, ["only"]).collect()} == {f"feature_{i}" for i in range(4)}
    with pytest.raises(ValueError):
        explain.importance(rf, FEATURES, "coefficients")
    with pytest.raises(ValueError, match="Invalid method"):
        explain.importance(rf, FEATURES, "guess")


def frames(spark, builtin, shap):
    return explain.compare(
        spark.createDataFrame(list(builtin.items()), "feature string, importance double"),
        spark.createDataFrame(list(shap.items()), "feature string, shap_importance double"),
    )


def test_compare_and_findings(spark):
    names = ["a", "b", "c", "d", "e", "f"]
    builtin = {n: 6.0 - i for i, n in enumerate(names)}
    shap = {n: float(i) for i, n in enumerate(names)}
    cmp = frames(spark, builtin, {**shap, "only_shap": 0.5})
    got = {r["feature"]: r for r in cmp.collect()}
    assert (got["a"]["builtin_rank"], got["a"]["shap_rank"]) == (1, 7)
    assert got["only_shap"]["builtin_rank"] == 0 and got["only_shap"]["builtin_importance"] == 0.0
    found = {(r["finding"], r["feature"]) for r in explain.surprising(cmp).collect()}
    assert ("high_rank_difference", "a") in found and ("builtin_higher", "a") in found and ("shap_higher", "f") in found
    assert explain.top_drivers(cmp, 2, "builtin").first()["feature"] == "only_shap"
    zero = frames(spark, {"a": 0.0}, {"a": 0.0}).first()
    assert (zero["builtin_importance_norm"], zero["shap_importance_norm"]) == (0.0, 0.0)


def test_case_studies(spark):
    rows = [(1, 1, 1), (2, 1, 1), (3, 1, 0), (4, 0, 1), (5, 0, 1), (6, 0, 0)]  # id, prediction, class
    df = spark.createDataFrame(rows, "id long, prediction int, class int").withColumn("score", F.lit(0.5))
    one = {(r["case_type"], r["id"]) for r in explain.case_studies(df, "id", 1).collect()}
    assert one == {("TP", 1), ("FP", 3), ("FN", 4)}
    two = {(r["case_type"], r["id"]) for r in explain.case_studies(df, "id", 2).collect()}
    assert two == {("TP", 1), ("TP", 2), ("FN", 4), ("FN", 5)}
    with pytest.raises(ValueError):
        explain.case_studies(df, "id", 0)


def test_risk_rules_follow_the_first_match(spark):
    names = {
        "time_since_signup": ("signup_time", "HIGH"), "purchase_value": ("purchase_time", "HIGH"), "hour_of_day": None,
        "amount": ("amount", "HIGH"), "browser": ("device", "MEDIUM"), "country": ("location", "MEDIUM"),
        "card_frequency": ("velocity", "HIGH"), "session_x": ("behaviour", "MEDIUM"), "zzz": None,
        "velocity_7": ("location", "MEDIUM"),  # holds "city", and the location rule comes first
    }
    drivers = spark.createDataFrame([(n,) for n in names], "feature string")
    none = spark.createDataFrame([], "finding string, feature string, avg_rank double")
    got = {r["feature"]: (r["category"], r["priority"]) for r in explain.risk_rules(drivers, none).collect()}
    assert got == {n: v for n, v in names.items() if v is not None}


def test_risk_rules_fill_up(spark):
    drivers = spark.createDataFrame([("amount",)], "feature string")
    none = spark.createDataFrame([], "finding string, feature string, avg_rank double")
    got = [r["feature"] for r in explain.risk_rules(drivers, none).collect()]
    assert sorted(got) == ["Model Monitoring", "Multiple", "amount"]
