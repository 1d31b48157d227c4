import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.operators import order


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


@pytest.mark.parametrize("cells", [2, 3, 7])
def test_add_preceding_does_not_depend_on_cells(spark, cells):
    values = [(i % 13, float(i % 3)) for i in range(200)]
    counts = (
        order.value_cells(spark.createDataFrame(values, "v long, w double"), ["v"], cells)
        .groupBy("v", F.col("v__cell").alias("cell"))
        .agg(F.sum("w").alias("w"))
        .withColumn("g", F.lit(1))
    )
    got = dict(rows(order.add_preceding(counts, ["g"], "cell", "v", ["w"]), "v", "w_before"))
    for v in range(13):
        assert got[v] == pytest.approx(sum(w for x, w in values if x < v))


def test_quantiles_match_numpy_per_group(spark):
    rng = np.random.default_rng(1)
    data = [(int(g), float(np.round(x, 1))) for g, x in zip(rng.integers(0, 3, 500), rng.normal(size=500))]
    df = spark.createDataFrame(data, "g int, x double")
    probs = {"a": 0.0, "b": 0.1, "c": 0.5, "d": 0.99, "e": 1.0}
    for r in order.quantiles(df, ["x"], probs, ["g"]).collect():
        xs = [x for g, x in data if g == r["g"]]
        for name, p in probs.items():
            assert r[name] == pytest.approx(np.quantile(xs, p))


def test_quantiles_skip_nulls_and_handle_one_value(spark):
    df = spark.createDataFrame([(None, 5), (None, None), (2.0, 5)], "x double, y int")
    got = {r["column_name"]: r["m"] for r in order.quantiles(df, ["x", "y"], {"m": 0.5}).collect()}
    assert got == {"x": 2.0, "y": 5.0}


def test_modes_take_the_smallest_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), ("c",), (None,)], "x string")
    r = order.modes(df, ["x"]).first()
    assert (r["top"], r["freq"], r["n_distinct"]) == ("a", 2, 3)


@pytest.mark.parametrize("parts", [1, 4, 16])
def test_hash_rank_is_exact_and_partition_free(spark, parts):
    df = spark.range(300).withColumn("g", F.col("id") % 2).repartition(parts)
    got = rows(order.hash_rank(df, ["g"], ["id"], 7), "g", "rank", "id")
    for g in (0, 1):
        assert [r for gg, r, _ in got if gg == g] == list(range(1, 151))
    if parts > 1:
        assert got == rows(order.hash_rank(df.repartition(1), ["g"], ["id"], 7), "g", "rank", "id")


@pytest.mark.parametrize("take", [{0: 0, 1: 5}, {0: 100, 1: 100}, {0: 1, 1: 99}, {0: 500, 1: 3}])
def test_mark_smallest_counts(spark, take):
    df = spark.range(200).withColumn("g", (F.col("id") % 2).cast("int"))
    marked = order.mark_smallest(df, take, "g", ["id"], 3)
    got = {r["g"]: r["n"] for r in marked.groupBy("g").agg(F.count_if("taken").alias("n")).collect()}
    assert got == {g: min(k, 100) for g, k in take.items()}
    ranked = {(r["g"], r["id"]) for r in order.hash_rank(df, ["g"], ["id"], 3).collect() if r["rank"] <= take[r["g"]]}
    assert {(r["g"], r["id"]) for r in marked.where("taken").collect()} == ranked


def test_mark_smallest_inside_one_cell(spark, monkeypatch):
    monkeypatch.setattr(order, "HASH_CELL_SHIFT", 2**30)
    df = spark.range(200).withColumn("g", F.when(F.col("id") < 190, (F.col("id") % 2).cast("int")))
    marked = order.mark_smallest(df, {0: 17, 1: 40}, "g", ["id"], 3)
    got = {r["g"]: r["n"] for r in marked.groupBy("g").agg(F.count_if("taken").alias("n")).collect()}
    assert got == {0: 17, 1: 40, None: 0}


def test_mark_smallest_without_classes(spark):
    marked = order.mark_smallest(spark.range(50), {0: 20}, None, ["id"], 1)
    assert marked.where("taken").count() == 20


@pytest.mark.parametrize("limit,keys,want", [(100, 5, (56, None)), (10, 5, (6, 50)), (10, 0, (3, 53))])
def test_route_hot(spark, monkeypatch, limit, keys, want):
    monkeypatch.setattr(order, "MAX_HOT_KEYS", keys)
    df = spark.createDataFrame([("a",)] * 50 + [("b",)] * 3 + [(None,)] * 3, "k string")
    light, heavy = order.route_hot(df, "k", limit, F.col("k").isNotNull())
    assert (light.count(), heavy and heavy.count()) == want


def test_carry_fill_across_cells(spark):
    data = [(i, None if i % 7 else float(i), None if i < 5 or i > 90 else "x%d" % i) for i in range(1, 100)]
    df = spark.createDataFrame(data, "k long, x double, s string").repartition(8)
    got = {r["k"]: (r["x"], r["s"]) for r in order.carry_fill(df, ["x", "s"], "k").collect()}
    for k in range(1, 100):
        assert got[k][0] == (7.0 if k < 7 else float(k // 7 * 7))
        assert got[k][1] == ("x5" if k < 5 else "x90" if k > 90 else "x%d" % k)


def test_carry_fill_per_group_with_null_group(spark):
    data = [(1, "a", None), (2, "a", 1.0), (3, None, 5.0), (4, "a", None), (5, None, None), (6, "b", None)]
    df = spark.createDataFrame(data, "k long, g string, x double")
    got = {r["k"]: r["x"] for r in order.carry_fill(df, ["x"], "k", ["g"]).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: 5.0, 4: 1.0, 5: 5.0, 6: None}


@pytest.mark.parametrize("by", [[], ["g"]])
def test_bracket_quantiles_equal_the_counted_ones(spark, by, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [
        (None if i % 50 == 0 else int(i % 3), float(rng.normal()), float(rng.integers(0, 5)), None if i % 7 else float(i), None)
        for i in range(6_000)
    ]
    df = spark.createDataFrame(rows, "g int, a double, b double, c double, d double").repartition(5)
    probs = {"lo": 0.0, "q1": 0.25, "median": 0.5, "p99": 0.99, "hi": 1.0}
    as_rows = lambda t: sorted(map(str, t.collect()))
    cols = ["a", "b", "c", "d"]
    want = as_rows(order.quantiles_by_cells(df, cols, probs, by))
    assert as_rows(order.quantiles(df, cols, probs, by)) == want
    # Coarse sketches, one group too many, NaN: the same numbers, some of them by counting all values.
    monkeypatch.setattr(order, "SKETCH_ACCURACY", 20)
    assert as_rows(order.quantiles(df, cols, probs, by)) == want
    monkeypatch.setattr(order, "BRACKET_GROUPS", 1)
    assert as_rows(order.quantiles(df, cols, probs, by)) == want
    odd = df.unionByName(df.limit(3).withColumn("a", F.lit(float("nan"))))
    assert as_rows(order.quantiles(odd, cols, probs, by)) == as_rows(order.quantiles_by_cells(odd, cols, probs, by))
    assert order.quantiles(df.limit(0), cols, probs, by).count() == 0
