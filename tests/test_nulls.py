"""Rows with null labels, groups or features are kept, or refused loudly."""

import pytest
from pyspark.sql import functions as F

from riskframe.operators import attribution, lineage, metrics, models, resample, split


def test_folds_keep_rows_without_label(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else i % 2) for i in range(1000)], "id long, class int")
    got = split.folds(df, ["id"], "class", 5)
    assert got.count() == 1000
    assert got.where("fold is null").count() == 0
    assert {r["count"] for r in got.where("class is null").groupBy("fold").count().collect()} == {20}


def test_stratified_refuses_null_labels(spark):
    df = spark.createDataFrame([(i, None if i == 3 else i % 2) for i in range(20)], "id long, class int")
    with pytest.raises(ValueError, match="null"):
        split.stratified(df, ["id"], "class")


def test_ranking_scores_of_a_null_group(spark):
    rows = [(g, i % 2, i / 10) for g in ("a", None) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, class int, score double")
    df = df.withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    got = {(r["g"], r["metric"]): r["value"] for r in metrics.evaluate(df, by=["g"]).collect()}
    assert got[None, "roc_auc"] is not None and got[None, "roc_auc"] == got["a", "roc_auc"]
    assert got[None, "pr_auc"] == got["a", "pr_auc"]


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_smote_refuses_missing_features(spark, bad):
    df = spark.createDataFrame([(i, float(i), bad if i == 2 else 1.0, int(i < 6)) for i in range(30)], "id long, x double, y double, class int")
    with pytest.raises(ValueError, match="null or NaN"):
        resample.smote(df, ["id"], "class", ["x", "y"])


def test_background_larger_than_a_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([(i, float(i % 7), float(i % 3), int(i % 7 > 3)) for i in range(60)], "id long, x double, y double, class int")
    model = models.train(df, "logistic_regression", ["x", "y"], "class")
    few = attribution.sampled_phi(model, df.limit(5), ["id"], ["x", "y"], df, n_permutations=4, n_background=1500)
    monkeypatch.setattr(attribution, "BROADCAST_BACKGROUND", 0)
    many = attribution.sampled_phi(model, df.limit(5), ["id"], ["x", "y"], df, n_permutations=4, n_background=1500)
    key = lambda r: (r["id"], r["feature"])
    a, b = sorted(few.collect(), key=key), sorted(many.collect(), key=key)
    assert [r["phi"] for r in a] == pytest.approx([r["phi"] for r in b]) and len(a) == 10


class _Cluster:
    """A session as a cluster shows it."""

    class sparkContext:
        master = "yarn"

    class conf:
        @staticmethod
        def get(key, default=None):
            return default


def test_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        lineage.work_dir(_Cluster())
