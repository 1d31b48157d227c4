import numpy as np
import pytest

from riskframe.operators import metrics


def brute(data):
    y = np.array([d[0] for d in data])
    s = np.array([d[1] for d in data])
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    ap, last = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        hit = (y[s >= t] == 1).sum()
        recall = hit / len(pos)
        ap += (recall - last) * hit / (s >= t).sum()
        last = recall
    return auc, ap


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    return [(int(rng.random() < 0.3), float(np.round(rng.random(), 1)), int(g)) for g in rng.integers(0, 3, 300)]


def test_areas_match_brute_force(spark, data):
    df = spark.createDataFrame(data, "class int, score double, g int")
    r = metrics.ranking_scores(df).first()
    assert (r["roc_auc"], r["pr_auc"]) == pytest.approx(brute(data))
    for r in metrics.ranking_scores(df, by=["g"]).collect():
        assert (r["roc_auc"], r["pr_auc"]) == pytest.approx(brute([d for d in data if d[2] == r["g"]]))


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.9)], "class int, score double")
    r = metrics.ranking_scores(df).first()
    assert r["roc_auc"] is None and r["pr_auc"] is None
    ones = spark.createDataFrame([(1, 0.1), (1, 0.9)], "class int, score double")
    r = metrics.ranking_scores(ones).first()
    assert r["roc_auc"] is None and r["pr_auc"] == 1.0


def test_no_positive_predictions(spark):
    df = spark.createDataFrame([(1, 0, 0.2), (0, 0, 0.1)], "class int, prediction int, score double")
    r = metrics.scores(df).first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (0.5, 0.0, 0.0, 0.0)
    cells = {(r["actual"], r["predicted"]): r["n"] for r in metrics.confusion(df).collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}
    assert {r["row"] for r in metrics.report(df).collect()} == {"0", "1", "accuracy", "macro avg", "weighted avg"}


def test_evaluate_selects_metrics(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (0, 0, 0.1)], "class int, prediction int, score double")
    assert {r["metric"]: r["value"] for r in metrics.evaluate(df, metrics=["f1", "roc_auc"]).collect()} == {"f1": 1.0, "roc_auc": 1.0}
    with pytest.raises(ValueError, match="Invalid metrics"):
        metrics.evaluate(df, metrics=["mcc"])
