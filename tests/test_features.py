import datetime as dt
import random

import pytest


from riskframe.functions import scalar
from riskframe.operators import features, order

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, user_id string, purchase_time timestamp_ntz"


def brute(data, hours, closed):
    out = {}
    for i, u, t in data:
        if u is None or t is None:
            out[i] = None
            continue
        same = [x for _, v, x in data if v == u and x is not None]
        low = t - dt.timedelta(hours=hours)
        out[i] = sum(low <= x <= t for x in same) - 1 if closed == "both" else sum(low <= x < t for x in same)
    return out


@pytest.fixture(scope="module")
def data():
    rng = random.Random(5)
    rows = [
        (i, rng.choice(["hot", "hot", "hot", "a", "b", None]), T0 + dt.timedelta(minutes=30 * rng.randrange(120)))
        for i in range(150)
    ]
    return [*rows, (150, "hot", None), (151, None, None)]


@pytest.mark.parametrize("closed", ["both", "left"])
@pytest.mark.parametrize("max_rows,hot_keys", [(10**6, 100), (20, 100), (0, 1)])
def test_velocity_matches_brute_force(spark, monkeypatch, data, closed, max_rows, hot_keys):
    monkeypatch.setattr(order, "MAX_HOT_KEYS", hot_keys)
    df = spark.createDataFrame(data, SCHEMA)
    out = features.velocity(df, windows=["1h", "24h"], closed=closed, max_group_rows=max_rows, cell_hours=0.7)
    name = "transaction_count_" if closed == "both" else "transactions_last_"
    assert out.count() == len(data)
    for w, hours in (("1h", 1), ("24h", 24)):
        got = {r["id"]: r[name + w] for r in out.collect()}
        assert got == brute(data, hours, closed)


@pytest.mark.parametrize("max_rows", [10**6, 20])
def test_user_gaps_match_brute_force(spark, data, max_rows):
    df = spark.createDataFrame(data, SCHEMA)
    out = features.user_gaps(df, tie_break="id", max_group_rows=max_rows, cell_hours=0.7)
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == len(data)
    for user in ("hot", "a", "b"):
        mine = sorted((t, i) for i, u, t in data if u == user and t is not None)
        gaps = [0.0] + [(b[0] - a[0]).total_seconds() / 3600 for a, b in zip(mine, mine[1:])]
        for (_, i), gap in zip(mine, gaps):
            assert got[i]["time_since_last_transaction"] == pytest.approx(gap)
            assert got[i]["total_transactions_per_user"] == len(mine)
            assert got[i]["avg_time_between_transactions"] == pytest.approx(sum(gaps) / len(gaps))
    assert got[151]["total_transactions_per_user"] is None


def test_invalid_windows(spark, data):
    df = spark.createDataFrame(data, SCHEMA)
    with pytest.raises(ValueError, match="Invalid windows"):
        features.velocity(df, windows=["2h"])
    with pytest.raises(ValueError, match="Invalid closed"):
        features.velocity(df, closed="right")
    with pytest.raises(ValueError, match="not found"):
        features.velocity(df, user="nobody")


def test_velocity_shares_one_shuffle(tx):
    plan = features.velocity(tx, windows=["1h", "24h", "7d"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_right_closed_bins(spark):
    values = [-1.0, 0.0, 0.5, 1.0, 1.5, 24.0, 24.1, 168.0, 168.1, None]
    df = spark.createDataFrame([(v,) for v in values], "h double")
    got = [r[0] for r in df.select(scalar.right_closed_bin("h")).collect()]
    assert got == [None, None, "0-1h", "0-1h", "1-24h", "1-24h", "24-168h", "24-168h", ">168h", None]


def test_time_features(spark):
    df = spark.createDataFrame([(T0, T0 + dt.timedelta(days=1, hours=5, minutes=30))], "signup_time timestamp_ntz, purchase_time timestamp_ntz")
    r = features.time_features(df).first()
    assert (r["hour_of_day"], r["day_of_week"], r["time_since_signup"]) == (5, 1, 29.5)
    assert (r["signup_year"], r["signup_month"], r["signup_day"], r["signup_hour"]) == (2024, 1, 1, 0)


def test_scalar_helpers(spark):
    df = spark.createDataFrame([(2.0, 0.0, "Total COST")], "a double, b double, s string")
    r = df.select(
        scalar.clamp01("a").alias("c"), scalar.safe_ratio("a", "b").alias("r"),
        scalar.contains_any("s", ["cost"]).alias("k"), scalar.uniform(["a"], 1).alias("u"),
    ).first()
    assert (r["c"], r["r"], r["k"]) == (1.0, 0.0, True) and 0 <= r["u"] < 1
