"""The registered queries agree with their SQL on the small tables."""

import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

import __spark_entry__ as entry_module
from check_oracle import rows_of

SAMPLE = (
    "cln3_fill_median_mode", "cln5_forward_fill_per_user", "cln7_keep_first", "jon1_ip_range_join", "win1_velocity_ties",
    "win3_user_gaps", "agg10_describe_by_label", "agg12_histogram_by_label", "rsk5_summary", "sta1_mann_whitney",
    "spl1_stratified_exact", "res2_undersample", "met1_evaluate_all", "mod10_margins", "exp12_risk_rules",
)


def test_entry(spark):
    df = entry_module.entry(spark)
    assert {"device_id", "fraud_rate", "risk_ratio"} <= set(df.columns) and df.count() > 0


def test_every_sql_has_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
    assert len(entry_module.queries()) > 120


@pytest.mark.parametrize("name", SAMPLE)
def test_query_agrees_with_sql(spark, sf, name):
    con = duckdb.connect()
    for f in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    df = entry_module.queries()[name](spark, sf)
    cur = con.execute(entry_module.oracle_sql()[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, cur.fetchall())
