import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import encode, knn, resample, scale, split


# --- encoding -----------------------------------------------------------------


def test_label_codes_follow_sorted_values(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("z",), ("b",)], "s string")
    mapping = encode.label_fit(df, ["s", "absent"])
    assert {r["value"]: r["code"] for r in mapping.collect()} == {"a": 0, "b": 1, "nan": 2, "z": 3}
    out = encode.label_apply(df, mapping, ["s"], drop_original=True)
    assert out.columns == ["s_idx"]
    assert sorted(r[0] for r in out.collect()) == [0, 1, 1, 2, 3]


def test_label_codes_of_many_values(spark):
    df = spark.range(3000).select(F.md5(F.col("id").cast("string")).alias("s"))
    got = {r["value"]: r["code"] for r in encode.label_fit(df, ["s"]).collect()}
    assert [got[v] for v in sorted(got)] == list(range(3000))


def test_unseen_value_is_null(spark):
    mapping = encode.label_fit(spark.createDataFrame([("a",)], "s string"), ["s"])
    out = encode.label_apply(spark.createDataFrame([("q",)], "s string"), mapping, ["s"])
    assert out.first()["s_idx"] is None


def test_onehot(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "id int, s string")
    values = encode.onehot_fit(df, ["s"])
    full = encode.onehot_apply(df, values, drop_first=False).orderBy("id")
    assert [tuple(r) for r in full.collect()] == [(1, 1, 0), (2, 0, 1), (3, 0, 0)]
    assert encode.onehot_apply(df, values).columns == ["id", "s_y"]
    with pytest.raises(ValueError, match="more than 1 values"):
        encode.onehot_fit(df, ["s"], max_values=1)
    with pytest.raises(ValueError, match="No categorical"):
        encode.label_fit(df.select("id"))


# --- scaling ------------------------------------------------------------------


def test_scalers(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (8.0, 5.0)], "x double, c double")
    std = scale.apply(df, scale.fit(df, ["x", "c"]))
    assert [r["x"] for r in std.collect()] == pytest.approx(list((np.array([1, 3, 8]) - 4) / np.std([1, 3, 8])))
    assert {r["c"] for r in std.collect()} == {0.0}
    mm = scale.apply(df, scale.fit(df, ["x", "c"], "minmax"))
    assert [r["x"] for r in mm.collect()] == pytest.approx([0, 2 / 7, 1])
    assert {r["c"] for r in mm.collect()} == {0.0}
    with pytest.raises(ValueError, match="Invalid kind"):
        scale.fit(df, ["x"], "robust")
    with pytest.raises(ValueError, match="must be fitted"):
        scale.apply(df, None)


# --- splitting ----------------------------------------------------------------


@pytest.fixture(scope="module")
def labelled(spark):
    return spark.range(500).select("id", (F.col("id") % 10 == 0).cast("int").alias("class"))


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_split_sizes_and_stability(labelled, parts):
    out = split.stratified(labelled.repartition(parts), ["id"])
    sizes = {(r["split"], r["class"]): r["n"] for r in split.split_distribution(out, "class").collect()}
    assert sizes == {("test", 0): 90, ("train", 0): 360, ("test", 1): 10, ("train", 1): 40}
    want = {r["id"] for r in split.stratified(labelled, ["id"]).where("split = 'test'").collect()}
    assert {r["id"] for r in out.where("split = 'test'").collect()} == want


def test_split_falls_back_without_strata(spark):
    df = spark.range(10).select("id", (F.col("id") == 0).cast("int").alias("class"))
    assert split.stratified(df, ["id"]).where("split = 'test'").count() == 2


def test_split_arguments(labelled):
    for size in (0, 1, 1.5):
        with pytest.raises(ValueError, match="test_size"):
            split.stratified(labelled, ["id"], test_size=size)
    with pytest.raises(ValueError, match="n_folds"):
        split.folds(labelled, ["id"], "class", 1)
    assert 50 < split.stratified(labelled, ["id"], exact=False).where("split = 'test'").count() < 150


def test_prepare_and_split(tx):
    out = split.prepare_and_split(tx, ["event_id"])
    assert "class" not in out.features and "event_id" not in out.features and "user_id" not in out.features
    assert out.train.count() + out.test.count() == tx.count()
    assert out.train.join(out.test, "event_id").count() == 0


def test_folds_are_even_per_class(labelled):
    out = split.folds(labelled, ["id"], "class", 5)
    assert {r["count"] for r in out.where("class = 0").groupBy("fold").count().collect()} == {90}
    assert {r["count"] for r in out.where("class = 1").groupBy("fold").count().collect()} == {10}


def test_samples(labelled):
    assert split.sample_rows(labelled, ["id"], 17).count() == 17
    got = split.sample_per_class(labelled, ["id"], "class", {0: 30, 1: 1000})
    assert {r["class"]: r["count"] for r in got.groupBy("class").count().collect()} == {0: 30, 1: 50}


# --- neighbours and resampling ------------------------------------------------


@pytest.mark.parametrize("block", [8, 32, 4096])
def test_nearest_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(knn, "BLOCK_ROWS", block)
    rng = np.random.default_rng(0)
    # a dense clump with a third of the rows, and a spread cloud
    pts = np.vstack([rng.normal(0, 0.01, (70, 3)), rng.normal(0, 2, (130, 3))])
    rows = [(f"{i:04d}", 1, [float(v) for v in p]) for i, p in enumerate(pts)]
    df = spark.createDataFrame(rows, "vid string, n bigint, vec array<double>")
    got = {r["vid"]: [x["nvid"] for x in r["near"]] for r in knn.nearest(df, 5).collect()}
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    assert got == {f"{i:04d}": [f"{j:04d}" for j in np.argsort(d[i], kind="stable")[:5]] for i in range(len(pts))}


@pytest.mark.parametrize("rows", [8, 48])
def test_nearest_across_groups_ships_no_vectors_through_the_driver(spark, monkeypatch, rows):
    monkeypatch.setattr(knn, "BLOCK_ROWS", 8)
    for name in ("GROUP_ROWS", "MIN_GROUP_ROWS"):
        monkeypatch.setattr(knn, name, rows, raising=False)
    rng = np.random.default_rng(1)
    pts = np.round(rng.normal(0, 1, (300, 4)), 1)  # many equal distances
    pts = np.unique(np.vstack([pts, pts[:40] + 1e9]), axis=0)
    df = spark.createDataFrame([(f"{i:04d}", 1, [float(v) for v in p]) for i, p in enumerate(pts)], "vid string, n bigint, vec array<double>")
    near = knn.nearest(df, 5)
    got = {r["vid"]: [x["nvid"] for x in r["near"]] for r in near.collect()}
    d = np.sqrt(((pts[:, None] - pts[None]) ** 2).sum(-1))
    np.fill_diagonal(d, np.inf)
    assert got == {f"{i:04d}": [f"{j:04d}" for j in np.argsort(d[i], kind="stable")[:5]] for i in range(len(pts))}
    # Spark broadcasts small sides of joins: the rows that ask were one, whatever they grew to
    assert "MapInPandas" not in near._jdf.queryExecution().executedPlan().toString()


def test_nearest_with_fewer_points_than_k(spark):
    df = spark.createDataFrame([("a", 1, [0.0]), ("b", 1, [1.0])], "vid string, n bigint, vec array<double>")
    assert {r["vid"]: len(r["near"]) for r in knn.nearest(df, 5).collect()} == {"a": 1, "b": 1}


@pytest.fixture(scope="module")
def unbalanced(spark):
    rng = np.random.default_rng(2)
    rows = [(i, float(rng.normal()), float(rng.normal()), int(i < 12)) for i in range(150)]
    rows += [(200 + i, 5.0, 5.0, 1) for i in range(7)]  # copies
    return spark.createDataFrame(rows, "id long, a double, b double, class int")


def test_smote_size_and_segments(unbalanced):
    out = resample.smote(unbalanced, ["id"], "class", ["a", "b"], ratio=0.5, k=3)
    n = {r["class"]: r["count"] for r in out.groupBy("class").count().collect()}
    assert n == {0: 138, 1: 69}
    minority = np.array([[r["a"], r["b"]] for r in unbalanced.where("class = 1").collect()])
    bases = {r["id"]: np.array([r["a"], r["b"]]) for r in unbalanced.collect()}
    for r in out.where("copy > 0").collect():
        base, x = bases[r["id"]], np.array([r["a"], r["b"]])
        order = np.argsort(((minority - base) ** 2).sum(1), kind="stable")
        near = minority[order[: 3 + 1]]  # the base itself is among them
        steps = near - base
        on_segment = False
        for s in steps:
            length = s @ s
            t = (x - base) @ s / length if length > 0 else 0.0
            on_segment |= -1e-9 <= t <= 1 + 1e-9 and np.allclose(base + t * s, x, atol=1e-9)
        assert on_segment
    assert out.exceptAll(resample.smote(unbalanced.repartition(7), ["id"], "class", ["a", "b"], 0.5, 3)).count() == 0


def test_smote_noop_when_ratio_is_met(unbalanced):
    assert resample.smote(unbalanced, ["id"], ratio=0.01).where("copy > 0").count() == 0


def test_undersample(unbalanced):
    out = resample.undersample(unbalanced, ["id"], ratio=0.5)
    assert {r["class"]: r["count"] for r in out.groupBy("class").count().collect()} == {0: 38, 1: 19}
    assert out.exceptAll(unbalanced).count() == 0
    both = resample.smote_undersample(unbalanced, ["id"], "class", ["a", "b"], 0.3, 0.5)
    assert {r["class"]: r["count"] for r in both.groupBy("class").count().collect()} == {0: 82, 1: 41}


@pytest.mark.parametrize("n0,want", [(1010, ("smote_undersample", 0.1, 0.5)), (110, ("smote", 0.5, None)), (60, ("smote", 0.3, None)), (50, ("class_weights", None, None))])
def test_strategy(spark, n0, want):
    df = spark.range(n0 + 10).select((F.col("id") < 10).cast("int").alias("class"))
    r = resample.choose_strategy(df).first()
    assert (r["strategy"], r["smote_ratio"], r["under_ratio"]) == want


def test_one_class_weight(spark):
    df = spark.range(5).select(F.lit(0).alias("class"))
    assert resample.scale_pos_weight(df).first()[0] == 1.0
    with pytest.raises(ValueError, match="two classes"):
        resample.undersample(df.withColumn("id", F.lit(1)), ["id"])


@pytest.mark.parametrize("strategy,sizes", [(None, {0: 138, 1: 19}), ("smote", {0: 138, 1: 138}), ("undersample", {0: 19, 1: 19}), ("smote_undersample", {0: 138, 1: 138})])
def test_preprocessing(unbalanced, strategy, sizes):
    steps = resample.Preprocessing("standard", strategy)
    train = steps.fit_train(unbalanced, ["id"], ["a", "b"])
    assert {r["class"]: r["count"] for r in train.groupBy("class").count().collect()} == sizes
    assert steps.transform(unbalanced).count() == unbalanced.count()


def test_preprocessing_arguments(unbalanced):
    with pytest.raises(ValueError, match="Invalid scaler"):
        resample.Preprocessing("robust")
    with pytest.raises(ValueError, match="Invalid resampling"):
        resample.Preprocessing("standard", "adasyn")
    with pytest.raises(ValueError, match="must be fitted"):
        resample.Preprocessing().transform(unbalanced)


def test_smote_searches_neighbours_once(spark, unbalanced):
    grown = resample.smote(unbalanced, ["id"], "class", ["a", "b"], 0.5)
    assert "InPandas" not in grown._jdf.queryExecution().toString()
