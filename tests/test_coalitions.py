import itertools
import math

import numpy as np
import pytest

from riskframe.operators import attribution, coalitions, models
from riskframe.sources import canonical

FEATURES = [f"f{i}" for i in range(5)]


@pytest.fixture(scope="module")
def data(spark, sf):
    return canonical.wide_features(spark, sf).select("vec_id", *FEATURES, "Class").cache()


def walk(tree, row, known, i=0):
    """v(known) of one row by the definition."""
    f = int(tree["feature"][i])
    if f < 0:
        return tree["mean"][i]
    a, b = int(tree["left"][i]), int(tree["right"][i])
    if f in known:
        return walk(tree, row, known, a if row[f] <= tree["threshold"][i] else b)
    return tree["share"][i] * walk(tree, row, known, a) + (1 - tree["share"][i]) * walk(tree, row, known, b)


def enumerated(tree, row):
    k = len(row)
    out = np.zeros(k)
    for i in range(k):
        others = [j for j in range(k) if j != i]
        for n in range(k):
            w = math.factorial(n) * math.factorial(k - 1 - n) / math.factorial(k)
            out[i] += sum(w * (walk(tree, row, {*s, i}) - walk(tree, row, s)) for s in itertools.combinations(others, n))
    return out


@pytest.mark.parametrize("kind", ["random_forest", "gradient_boosting"])
@pytest.mark.parametrize("grid", [0, 40, 4096])
def test_equal_to_enumeration(data, kind, grid, monkeypatch):
    monkeypatch.setattr(coalitions, "GRID_CELLS", grid)
    monkeypatch.setattr(coalitions, "CELLS_AT_ONCE", 3)
    m = models.train(data, kind, FEATURES, "Class", n_estimators=3, **({} if kind == "random_forest" else {"max_depth": 4}))
    x = np.array([[r[f] for f in FEATURES] for r in data.orderBy("vec_id").limit(5).collect()])
    x = np.vstack([x, [np.nan] * 5, [np.inf] * 5, [-np.inf] * 5])
    for r in attribution.packed_trees(m.stages[-1]).collect():
        tree = coalitions.loads(r["packed"])
        if grid != 4096:
            tree["grids"] = dict(coalitions._grids(tree))
        want = np.array([enumerated(tree, row) for row in x])
        assert np.abs(coalitions.phi(tree, x) - want).max() < 1e-9
        assert len(coalitions.leaves(tree)) == (tree["left"] < 0).sum()


def test_leaf_way_gives_the_same(data, monkeypatch):
    m = models.train(data, "random_forest", FEATURES, "Class", n_estimators=4)
    as_rows = lambda: sorted((r.vec_id, r.feature, round(r.phi, 9), round(r.base_value, 9)) for r in attribution.tree_phi(m, data, ["vec_id"], FEATURES).collect())
    by_table = as_rows()
    assert len(by_table) == 5 * data.count()
    leaf = attribution.leaf_table(m.stages[-1])
    x = np.array([[r[f] for f in FEATURES] for r in data.orderBy("vec_id").collect()])
    by_leaf = attribution.leaf_phi(x, leaf)
    got = np.array([p for _, _, p, _ in by_table]).reshape(len(x), 5)
    assert np.abs(got - by_leaf).max() < 1e-8


def test_a_lone_leaf_explains_nothing(spark):
    rows = spark.createDataFrame([(i, float(i), 1) for i in range(20)], "id long, f0 double, class int")
    m = models.train(rows, "random_forest", ["f0"], n_estimators=2, class_weight=None)
    got = attribution.tree_phi(m, rows, ["id"], ["f0"]).collect()
    assert len(got) == 20 and all(r.phi == 0 for r in got)
