import pytest
from pyspark.sql import functions as F

from riskframe.operators import clean


@pytest.fixture(scope="module")
def small(spark):
    return spark.createDataFrame(
        [(1, 1.0, "a", 5), (2, None, "b", None), (3, 3.0, None, 7), (4, 8.0, "b", 8)],
        "id long, x double, s string, n int",
    )


def column(df, name, key="id"):
    return [r[name] for r in df.orderBy(key).collect()]


def test_drop(small):
    assert column(clean.handle_missing(small, "drop", ["x"]), "id") == [1, 3, 4]
    assert column(clean.handle_missing(small, "drop"), "id") == [1, 4]


def test_fill_constant_casts(small):
    out = clean.handle_missing(small, "fill", ["x", "n"], fill_value=0)
    assert column(out, "x") == [1.0, 0.0, 3.0, 8.0]
    assert column(out, "n") == [5, 0, 7, 8]


def test_fill_median_and_mode(small):
    out = clean.handle_missing(small, "fill")
    assert column(out, "x") == [1.0, 3.0, 3.0, 8.0]
    assert column(out, "s") == ["a", "b", "b", "b"]
    assert column(out, "n") == [5.0, 7.0, 7.0, 8.0]
    assert dict(out.dtypes)["id"] == "bigint"  # no nulls, so the type stays


def test_fill_all_null_column_uses_fallback(spark):
    df = spark.createDataFrame([(1, None)], "id long, s string")
    assert column(clean.handle_missing(df, "fill"), "s") == [""]
    assert column(clean.handle_missing(df, "fill", fallback="Unknown"), "s") == ["Unknown"]


def test_bad_arguments(small):
    with pytest.raises(ValueError, match="Invalid strategy"):
        clean.handle_missing(small, "guess")
    with pytest.raises(ValueError, match="order_by"):
        clean.handle_missing(small, "forward_fill")
    with pytest.raises(ValueError, match="not found"):
        clean.handle_missing(small, "drop", ["zzz"])
    with pytest.raises(ValueError, match="Invalid keep"):
        clean.remove_duplicates(small, ["s"], "middle", "id")


def test_remove_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 10), (2, "a", 20), (3, "b", 30), (4, None, 40), (5, None, 50)], "id long, k string, v int")
    assert column(clean.remove_duplicates(df, ["k"], "first", "id"), "v") == [10, 30, 40]
    assert column(clean.remove_duplicates(df, ["k"], "last", "id"), "v") == [20, 30, 50]
    assert column(clean.remove_duplicates(df, ["k"], False), "v") == [30]
    assert clean.remove_duplicates(df.union(df)).count() == 5
    assert clean.remove_duplicates(df, ["k"], "first", "id").columns == df.columns


def test_duplicates_count_null_rows_as_equal(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (2, 1)], "a int, b int")
    r = clean.duplicate_stats(df).first()
    assert (r["total_rows"], r["duplicate_count"]) == (3, 1)


def test_conflicting_duplicates(spark):
    df = spark.createDataFrame([("x", 0), ("x", 1), ("y", 1), ("y", 1)], "f string, class int")
    assert [r["f"] for r in clean.conflicting_duplicates(df, "class").collect()] == ["x"]


def test_null_profile(small):
    got = [(r["column_name"], r["missing_count"], r["missing_percent"]) for r in clean.null_profile(small).collect()]
    assert got == [("n", 1, 25.0), ("s", 1, 25.0), ("x", 1, 25.0)]


def test_datetimes(spark):
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "bad")], "id long, t string")
    out = clean.to_datetime(df, ["t"])
    assert dict(out.dtypes)["t"] == "timestamp_ntz"
    assert [v is None for v in column(out, "t")] == [False, True]
    assert clean.drop_bad_datetimes(out, ["t"]).count() == 2  # half of the rows are bad: keep
    many = spark.range(300).select(F.when(F.col("id") > 0, F.lit("2024-01-01")).otherwise("bad").alias("t"))
    assert clean.drop_bad_datetimes(clean.to_datetime(many, ["t"]), ["t"]).count() == 299
    with pytest.raises(Exception):
        clean.to_datetime(df, ["t"], strict=True).collect()


def test_labels_and_numbers(spark):
    df = spark.createDataFrame([(1, ' "1" '), (2, '"0"'), (3, "2"), (4, "x"), (5, None)], "id long, class string")
    out = clean.clean_label(df, "class")
    assert column(out, "class") == [1, 0]
    num = clean.to_numeric(df, ["class"])
    assert column(num, "class") == [None, None, 2.0, None, None]


def test_fix_infinite(spark):
    df = spark.createDataFrame([(1, float("inf")), (2, 1.0), (3, 3.0), (4, float("-inf")), (5, float("nan"))], "id long, x double")
    assert column(clean.fix_infinite(df, ["x"]), "x") == [2.0, 1.0, 3.0, 2.0, 2.0]


def test_feature_selection(tx):
    df = clean.separate_features(tx, "ecommerce")
    assert "class" in df.columns and not {"user_id", "ip_address", "signup_time", "purchase_time"} & set(df.columns)
    assert clean.separate_features(tx, features=["age", "class"]).columns == ["age", "class"]
    with pytest.raises(ValueError, match="not found"):
        clean.separate_features(tx, features=["nope"])
    with pytest.raises(ValueError, match="No feature"):
        clean.separate_features(tx, features=["class"])
    with pytest.raises(ValueError, match="Invalid dataset"):
        clean.separate_features(tx, "shop")


def test_feature_info_and_column_kinds(tx):
    info = {r["column_name"]: r["role"] for r in clean.feature_info(tx, "class", ["user_id"]).collect()}
    assert info["class"] == "target" and info["user_id"] == "excluded" and info["age"] == "feature"
    assert clean.string_columns(tx) == ["device_id", "source", "browser", "sex"]
    assert "age" in clean.numeric_columns(tx) and "user_id" not in clean.numeric_columns(tx, ["user_id"])
