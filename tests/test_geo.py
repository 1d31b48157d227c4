import random

import pytest

from riskframe.operators import geo

SCHEMA = "lower_bound_ip_address long, upper_bound_ip_address long, country string"


def mapped(spark, ips, ranges, mode="range"):
    df = spark.createDataFrame(list(enumerate(ips)), "id int, ip_address double")
    out = geo.map_ip(df, spark.createDataFrame(ranges, SCHEMA), mode=mode)
    return [r["country"] for r in out.orderBy("id").collect()]


RANGES = [(10, 20, "A"), (30, 40, "B"), (70000, 200000, "C")]


def test_range_edges(spark):
    ips = [5.0, 10.0, 20.0, 20.9, 21.0, 25.0, 40.0, 70000.5, 131072.0, 200000.0, 200001.0, None]
    want = ["Unknown", "A", "A", "A", "Unknown", "Unknown", "B", "C", "C", "C", "Unknown", "Unknown"]
    assert mapped(spark, ips, RANGES) == want
    assert mapped(spark, ips, RANGES, "asof") == want


def test_exact_mode(spark):
    assert mapped(spark, [10.0, 11.0, 30.4], RANGES, "exact") == ["A", "Unknown", "B"]


def test_first_range_wins_in_overlaps_and_rows_stay(spark):
    ranges = [(0, 100, "A"), (50, 150, "B"), (60, 70, "C")]
    assert mapped(spark, [40.0, 55.0, 65.0, 120.0], ranges) == ["A", "A", "A", "B"]
    # nearest lower bound, then its upper bound
    assert mapped(spark, [40.0, 55.0, 65.0, 80.0, 120.0], ranges, "asof") == ["A", "B", "C", "Unknown", "Unknown"]


@pytest.mark.parametrize("broadcast_limit", [2_000_000, 0])
def test_random_ranges_match_brute_force(spark, monkeypatch, broadcast_limit):
    monkeypatch.setattr(geo, "BROADCAST_SEGMENTS", broadcast_limit)
    rng = random.Random(3)
    ranges, low = [], 0
    for i in range(60):
        low += rng.randrange(1, 40000)
        high = low + rng.randrange(0, 60000)
        ranges.append((low, high, f"c{i}"))
        low = high + 1
    ips = [float(rng.randrange(0, low + 1000)) for _ in range(400)]
    want = [next((c for a, b, c in ranges if a <= ip <= b), "Unknown") for ip in ips]
    assert mapped(spark, ips, ranges) == want
    assert mapped(spark, ips, ranges, "asof") == want


def test_invalid_mode(spark):
    with pytest.raises(ValueError, match="Invalid mode"):
        mapped(spark, [1.0], RANGES, "near")


def test_coverage(spark):
    df = spark.createDataFrame([("A",), ("A",), ("Unknown",)], "country string")
    r = geo.coverage(df).first()
    assert (r["countries"], r["unknown_rows"], r["total_rows"]) == (2, 1, 3)
