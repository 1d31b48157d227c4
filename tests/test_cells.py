"""Trees grown from counted cells are those of Spark's learners."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import cells, models, selection
from riskframe.operators import metrics as M

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def noisy(spark):
    """Rows of few values a feature, many of them equal, with a label that the features only hint at."""
    rng = np.random.default_rng(7)
    x = rng.integers(0, 9, size=(1500, 3))
    y = (x[:, 0] + (x[:, 1] > 4) * x[:, 2] + rng.normal(scale=3, size=1500) > 10).astype(int)
    rows = [(i, *[float(v) / 2 for v in x[i]], int(y[i])) for i in range(1500)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, class int")
    return selection.fold_table(df, ["id"], FEATURES, "class", 3, 42)


def held_out(data, scored, fold):
    """{(label): sorted scores} of counted rows."""
    rows = scored.where(F.col("fit") == fold).collect()
    return {y: np.sort(np.repeat([r["score"] for r in rows if r["label"] == y], [r["n"] for r in rows if r["label"] == y])) for y in (0, 1)}


@pytest.mark.parametrize("depth", [1, 3, 6])
def test_boosted_trees_score_as_spark_does(noisy, depth):
    counted = cells.count(noisy, FEATURES, "class", 3)
    assert counted.rows.sum() == 1500 and len(counted.label) < 1200
    params = models.spark_params("xgboost", {"n_estimators": 8, "max_depth": depth, "learning_rate": 0.2})
    scored = cells.score_fits(noisy, counted, [cells.Fit("xgboost", params, i, (1.0, 3.0)) for i in range(3)], 42)
    for fold in (0, 2):
        model = models.train(noisy.where(F.col("fold") != fold), "xgboost", FEATURES, class_weight={0: 1.0, 1: 3.0}, n_estimators=8, max_depth=depth, learning_rate=0.2)
        want = models.predict(model, noisy.where(F.col("fold") == fold)).select("class", "score").collect()
        got = held_out(noisy, scored, fold)
        for y in (0, 1):
            # a split in a gap between training values may lie anywhere in it, and equal gains are a matter of order
            far = np.abs(got[y] - np.sort([r["score"] for r in want if r["class"] == y])) > 1e-9
            assert far.mean() < 0.02


def test_a_deep_tree_without_bags_is_sparks_tree(noisy):
    """With equal bags the forest has nothing random left: every tree is the decision tree of all features."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import DecisionTreeClassifier
    from pyspark.ml.feature import VectorAssembler

    counted = cells.count(noisy, FEATURES, "class", 3)
    train = counted.rows.sum(axis=0)
    for depth, min_rows in ((2, 1), (5, 4), (30, 1), (30, 9)):
        votes = cells._class_trees(
            counted.bins, counted.label, np.stack([train] * 2), train > 0, np.array([0.6, 2.0]), [depth], min_rows, 3, []
        )
        got = dict(zip(map(tuple, counted.bins / 2), votes[0].mean(axis=0)))
        tree = DecisionTreeClassifier(labelCol="class", weightCol="w", maxDepth=depth, minInstancesPerNode=min_rows)
        flow = Pipeline(stages=[VectorAssembler(inputCols=FEATURES, outputCol="features"), tree])
        model = flow.fit(noisy.withColumn("w", F.when(F.col("class") == 1, 2.0).otherwise(0.6)))
        want = models.predict(model, noisy).collect()
        far = sum(abs(r["score"] - got[(r["a"], r["b"], r["c"])]) > 1e-9 for r in want)
        assert far == 0 if depth < 30 else far < 45  # which of equal gains is taken is a matter of rounding


def test_forests_from_cells_judge_as_well_as_sparks(noisy):
    params = {"n_estimators": 60, "max_depth": 6, "min_samples_leaf": 3}
    cv = selection.cross_validate(noisy.drop("fold"), ["id"], "random_forest", FEATURES, n_folds=3, folded=noisy, **params)
    got = {r["metric"]: r["mean"] for r in cv.summary.collect()}
    for fold in (0,):
        model = models.train(noisy.where(F.col("fold") != fold), "random_forest", FEATURES, **params)
        want = {r["metric"]: r["value"] for r in models.evaluate(model, noisy.where(F.col("fold") == fold)).collect()}
        mine = {r["metric"]: r["value"] for r in cv.folds.where(F.col("fold") == fold).collect()}
        assert set(mine) == set(M.METRICS) and all(abs(mine[m] - want[m]) < 0.04 for m in M.METRICS)
    assert got["roc_auc"] > 0.7


def test_a_search_takes_every_candidate_and_fold(noisy, monkeypatch):
    seen = []
    score_fits = cells.score_fits

    def spy(data, counted, fits, *args, **kwargs):
        seen.extend(fits)
        return score_fits(data, counted, fits, *args, **kwargs)

    monkeypatch.setattr(cells, "score_fits", spy)
    grid = {"n_estimators": [3, 5], "max_depth": [2, None], "min_samples_leaf": [1, 4]}
    found = selection.tune(noisy.drop("fold"), ["id"], "random_forest", FEATURES, grid=grid, cv=3, folded=noisy, scoring="roc_auc")
    assert len(seen) == 24 and {f.fold for f in seen} == {0, 1, 2}
    rows = found.candidates.collect()
    assert [r["params"] for r in rows] == [str(c) for c in selection.expand_grid(grid)]
    assert found.best_score == max(r["mean_score"] for r in rows) > 0.6
    forest = found.model.stages[-1]
    assert forest.getNumTrees == found.best_params["n_estimators"] and len(forest.trees) == forest.getNumTrees


def test_trees_in_common_are_the_trees_of_a_fit_alone(noisy):
    counted = cells.count(noisy, FEATURES, "class", 3)
    fits = [
        cells.Fit("random_forest", {"numTrees": n, "maxDepth": d, "minInstancesPerNode": m}, i, (1.0, 2.0))
        for n in (1, 4, 9) for d in (2, 5, 30) for m in (1, 6) for i in (0, 2)
    ] + [
        cells.Fit("xgboost", {"maxIter": n, "maxDepth": d, "stepSize": 0.3, "subsamplingRate": r}, 1, (1.0, 2.0))
        for n in (1, 3, 6) for d in (2, 4) for r in (1.0, 0.7)
    ]

    def rows(fits, i):
        found = cells.score_fits(noisy, counted, fits, 42).where(F.col("fit") == i).collect()
        return sorted((r["label"], r["prediction"], r["score"], r["n"]) for r in found)

    assert len({f.family() for f in fits}) == 4 + 4
    together = cells.score_fits(noisy, counted, fits, 42).cache()
    assert {r["fit"]: r["n"] for r in together.groupBy("fit").agg(F.sum("n").alias("n")).collect()} == dict.fromkeys(range(len(fits)), 500)
    for i in (0, 7, 14, 22, 34, 37, 41, 44, 47):
        all_of_it = sorted((r["label"], r["prediction"], r["score"], r["n"]) for r in together.where(F.col("fit") == i).collect())
        assert all_of_it == rows([fits[i]], 0)


def test_counted_rows_have_the_metrics_of_the_rows(noisy):
    scored = noisy.select("class", "fold", (F.col("a") > 2).cast("int").alias("prediction"), (F.col("b") / 5).alias("score"))
    counted = scored.groupBy("class", "fold", "prediction", "score").agg(F.count(F.lit(1)).alias("n"))
    for by in ([], ["fold"]):
        one = {(*[r[b] for b in by], r["metric"]): r["value"] for r in M.evaluate(scored, by=by).collect()}
        two = {(*[r[b] for b in by], r["metric"]): r["value"] for r in M.evaluate(counted, by=by, rows="n").collect()}
        assert one.keys() == two.keys() and all(one[k] == pytest.approx(two[k], abs=1e-12) for k in one)


def test_what_no_cell_can_hold_is_left_to_spark(noisy, monkeypatch):
    assert cells.count(noisy.withColumn("a", F.when(F.col("id") != 3, F.col("a"))), FEATURES, "class", 3) is None
    assert cells.count(noisy.withColumn("a", F.when(F.col("id") != 3, F.col("a")).otherwise(float("nan"))), FEATURES, "class", 3) is None
    assert cells.count(noisy.withColumn("class", F.col("class") + 1), FEATURES, "class", 3) is None
    assert cells.count(noisy.where("class = 0"), FEATURES, "class", 3) is None
    monkeypatch.setattr(cells, "MAX_BYTES", 1000)
    assert cells.count(noisy, FEATURES, "class", 3) is None
    found = selection.tune(noisy.drop("fold"), ["id"], "random_forest", FEATURES, grid={"n_estimators": [2], "max_depth": [2]}, cv=3, folded=noisy)
    assert found.candidates.count() == 1


def test_skewed_and_constant_features_keep_their_rare_values(spark):
    df = spark.range(3000).select(
        "id", F.when(F.col("id") % 500 == 0, 1.0).otherwise(0.0).alias("a"), F.lit(4).alias("b"), (F.col("id") * 1.5).alias("c"),
        (F.col("id") % 500 == 0).cast("int").alias("class"), (F.col("id") % 3).cast("int").alias("fold"),
    )
    counted = cells.count(df, FEATURES, "class", 3)
    assert counted.bins.max(axis=0).tolist() == [1, 0, cells.MAX_BINS - 1]
    sizes = np.bincount(counted.bins[:, 2], weights=counted.rows.sum(axis=0))
    assert sizes.sum() == 3000 and sizes.max() < 2 * 3000 / cells.MAX_BINS


def test_a_comparison_counts_its_folds_once(tx, monkeypatch):
    from riskframe.plans import comparison

    seen, counts = [], []
    count, score_fits = cells.count, cells.score_fits
    monkeypatch.setattr(cells, "count", lambda *a: (counts.append(a), count(*a))[1])
    monkeypatch.setattr(cells, "score_fits", lambda data, counted, fits, *a, **k: (seen.extend(fits), score_fits(data, counted, fits, *a, **k))[1])
    candidates = (
        comparison.Candidate("RF", "random_forest", "random_forest", 0.6, {}, {"n_estimators": [2], "max_depth": [2, 3]}),
        comparison.Candidate("GB", "gradient_boosting", "gradient_boosting", 0.5, {}, {"n_estimators": [2, 3], "max_depth": [2]}),
    )
    out = comparison.train_and_compare(tx, ["event_id"], candidates=candidates, n_folds=2)
    assert {r["model_name"] for r in out.board.collect()} == {"RF", "GB"} == set(out.models)
    # two candidates in two folds, then the best in two folds, for each kind
    assert len(counts) == 1 and sorted(f.kind for f in seen) == ["gradient_boosting"] * 6 + ["random_forest"] * 6
