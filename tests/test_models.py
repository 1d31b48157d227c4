import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import explain, models, selection
from riskframe.plans import comparison

FEATURES = [f"f{i}" for i in range(5)]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(200, 5))
    y = (x[:, 0] + 0.5 * x[:, 1] + rng.normal(scale=0.5, size=200) > 1.4).astype(int)
    rows = [(i, *[float(v) for v in x[i]], int(y[i])) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, " + ", ".join(f"{f} double" for f in FEATURES) + ", class int")
    return df.cache()


@pytest.fixture(scope="module")
def parts(data):
    return data.where("id < 160"), data.where("id >= 160")


@pytest.mark.parametrize("kind,params", [("logistic_regression", {}), ("random_forest", {"n_estimators": 5, "max_depth": 4}), ("gradient_boosting", {"n_estimators": 3}), ("xgboost", {"n_estimators": 3, "max_depth": 3}), ("lightgbm", {"n_estimators": 3})])
def test_train_and_evaluate(parts, kind, params):
    out = models.train_and_evaluate(*parts, kind, FEATURES, **params)
    got = {(r["split"], r["metric"]): r["value"] for r in out.metrics.collect()}
    assert len(got) == 12 and all(0 <= v <= 1 for v in got.values())
    assert got[("train", "roc_auc")] > 0.7
    assert out.predictions.where("prediction not in (0, 1) or score < 0 or score > 1").count() == 0


def test_logistic_penalty_matches_the_summed_loss(parts):
    """The gradient of C * sum(w * loss) + |b|^2 / 2 vanishes at the fitted coefficients."""
    train = parts[0]
    m = models.train(train, "logistic_regression", FEATURES, C=0.5).stages[-1]
    rows = train.collect()
    x = np.array([[r[f] for f in FEATURES] for r in rows])
    y = np.array([r["class"] for r in rows])
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    b = m.coefficients.toArray()
    p = 1 / (1 + np.exp(-(x @ b + m.intercept)))
    assert np.abs(0.5 * x.T @ (w * (p - y)) + b).max() < 1e-2


def test_bad_parameters(data):
    for kind, params, text in (
        ("svm", {}, "Unsupported"),
        ("random_forest", {"min_samples_split": 5}, "no Spark counterpart"),
        ("lightgbm", {"num_leaves": 31}, "no Spark counterpart"),
        ("lightgbm", {"max_depth": -1}, "no Spark counterpart"),
        ("logistic_regression", {"solver": "magic"}, "Invalid solver"),
    ):
        with pytest.raises(ValueError, match=text):
            models.train(data, kind, FEATURES, **params)
    with pytest.raises(ValueError, match="Invalid class_weight"):
        models.train(data, "random_forest", FEATURES, class_weight="heavy")
    assert models.spark_params("random_forest", {"max_depth": None})["maxDepth"] == models.MAX_DEPTH


def test_save_and_load(parts, tmp_path):
    m = models.train(parts[0], "random_forest", FEATURES, n_estimators=3, max_depth=3)
    models.save_model(m, str(tmp_path / "m"))
    again = models.load_model(str(tmp_path / "m"))
    a = models.predict(m, parts[1]).select("id", "score")
    assert a.exceptAll(models.predict(again, parts[1]).select("id", "score")).count() == 0


def test_cross_validation(data):
    cv = selection.cross_validate(data, ["id"], "logistic_regression", FEATURES, n_folds=3, metrics=["f1", "roc_auc"])
    assert cv.folds.count() == 6
    got = {r["metric"]: r for r in cv.summary.collect()}
    assert set(got) == {"f1", "roc_auc"}
    values = [r["value"] for r in cv.folds.where("metric = 'f1'").collect()]
    assert got["f1"]["mean"] == pytest.approx(np.mean(values)) and got["f1"]["std"] == pytest.approx(np.std(values))
    with pytest.raises(ValueError, match="Invalid metrics"):
        selection.cross_validate(data, ["id"], "random_forest", FEATURES, metrics=["mcc"])


def test_tuning(data):
    grid = {"n_estimators": [2], "max_depth": [1, 4]}
    found = selection.tune(data, ["id"], "random_forest", FEATURES, grid=grid, cv=2)
    assert found.best_params in selection.expand_grid(grid) and 0 <= found.best_score <= 1
    assert found.candidates.count() == 2
    with pytest.raises(ValueError, match="Invalid search"):
        selection.expand_grid(grid, "bayes")
    wide = {"a": [1, 2, 3], "b": [1, 2, 3]}
    assert selection.expand_grid(wide, "random", 4, 1) == selection.expand_grid(wide, "random", 4, 1)
    assert len(selection.expand_grid(wide, "random", 4, 1)) == 4 and len(selection.expand_grid(wide)) == 9


def entries(spark):
    metrics = {
        ("Model A", "baseline", 1.0): (0.85, 0.82, 0.90),
        ("Model B", "random_forest", 0.6): (0.90, 0.88, 0.92),
        ("Model C", "xgboost", 0.5): (0.88, 0.85, 0.91),
    }
    rows = [(*k, m, v) for k, vs in metrics.items() for m, v in zip(("f1", "pr_auc", "roc_auc"), vs)]
    return spark.createDataFrame(rows, "model_name string, model_type string, interpretability_score double, metric string, value double")


def test_leaderboard_by_hand(spark):
    board = selection.leaderboard(entries(spark)).orderBy("place")
    got = [(r["model_name"], round(r["overall_score"], 6)) for r in board.collect()]
    assert got == [("Model B", 0.88), ("Model C", 0.57), ("Model A", 0.3)]
    lead = {r["other_model"]: round(r["margin"], 6) for r in selection.margins(board).collect()}
    assert lead == {"Model A": 0.05, "Model C": 0.02}
    s = selection.board_summary(board).first()
    assert (s["best_model"], s["ranking"], s["total_models_compared"]) == ("Model B", "Model B, Model C, Model A", 3)


def test_leaderboard_ties_and_cv(spark):
    same = entries(spark).withColumn("value", F.lit(0.5)).withColumn("interpretability_score", F.lit(0.5))
    board = selection.leaderboard(same).orderBy("place").collect()
    assert [r["model_name"] for r in board] == ["Model A", "Model B", "Model C"]
    assert {r["normalised_performance"] for r in board} == {1.0}
    cv = spark.createDataFrame([("Model A", "f1", 0.99, 0.01)], "model_name string, metric string, mean double, std double")
    top = selection.leaderboard(entries(spark), cv).where("place = 1").first()
    assert top["model_name"] == "Model A" and top["performance_score"] == pytest.approx(0.98)


def test_leaderboard_arguments(spark):
    with pytest.raises(ValueError, match="Invalid primary_metric"):
        selection.leaderboard(entries(spark), primary_metric="accuracy")
    with pytest.raises(ValueError, match="must equal 1.0"):
        selection.leaderboard(entries(spark), interpretability_weight=0.3, performance_weight=0.5)


def test_train_and_compare(tx, tmp_path, spark):
    candidates = (
        comparison.Candidate("LR", "logistic_regression", "baseline", 1.0, {}),
        comparison.Candidate("RF", "random_forest", "random_forest", 0.6, {}, {"n_estimators": [2], "max_depth": [2, 3]}),
    )
    out = comparison.train_and_compare(tx, ["event_id"], candidates=candidates, n_folds=2)
    assert {r["model_name"] for r in out.board.collect()} == {"LR", "RF"} and out.board.where("place = 1").count() == 1
    comparison.save_json_summary(out, str(tmp_path), "ecommerce")
    assert spark.read.json(str(tmp_path / "leaderboard")).count() == 2
    assert explain.importance(out.models["RF"], out.features).count() == len(out.features)


def test_tuning_by_any_metric(spark, sf):
    from riskframe.queries.modelling import shared_rule_table

    data, features = shared_rule_table(spark, sf), ["source_code", "seo_share"]
    grid = {"n_estimators": [2, 3], "max_depth": [2]}
    folded = selection.fold_table(data, ["event_id"], features, "class", 2, 42)
    for scoring in ("pr_auc", "recall"):
        found = selection.tune(data, ["event_id"], "random_forest", features, grid=grid, cv=2, scoring=scoring, folded=folded)
        rows = found.candidates.collect()
        assert [(r.mean_score, r.std_score) for r in rows] == [(1.0, 0.0)] * 2 and found.best_params == {"n_estimators": 2, "max_depth": 2}
    with pytest.raises(ValueError, match="scoring"):
        selection.tune(data, ["event_id"], "random_forest", features, grid=grid, scoring="loss")


def test_no_candidate_is_trained_twice():
    kinds = [(c.kind, str(c.grid)) for c in comparison.CANDIDATES]
    assert len(set(kinds)) == len(kinds)


def test_tree_fits_deal_rows_to_tasks_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(models, "ROWS_PER_TASK", 100, raising=False)
    monkeypatch.setattr(models, "ROWS_WORTH_A_TASK", 50, raising=False)
    df = spark.range(1000, numPartitions=1).select(F.col("id").cast("double").alias("x"), (F.col("id") % 2).cast("int").alias("class"))
    sizes = []
    fit = models.Pipeline.fit
    monkeypatch.setattr(models.Pipeline, "fit", lambda self, data: (sizes.extend(r["count"] for r in data.groupBy(F.spark_partition_id()).count().collect()), fit(self, data))[1])
    models.train(df, "random_forest", ["x"], n_estimators=2, max_depth=2)
    assert sum(sizes) == 1000 and max(sizes) <= 150
