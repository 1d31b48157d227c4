"""Queries on sources, sinks and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators.lineage import work_dir
from riskframe.plans import etl
from riskframe.queries.base import BANK, DIRTY, RANGES, TX, with_ctes
from riskframe.sources import canonical as C
from riskframe.sources import tables as S

TX_COLUMNS = S.ECOMMERCE_SCHEMA.names
NTZ_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _folder(spark) -> str:
    return f"{work_dir(spark)}/{etl.run_name()}"


def src1_load_csv(spark, d):
    path = f"{_folder(spark)}/orders.csv"
    S.save(C.table(spark, d, "orders"), path, "csv", timestampNTZFormat=NTZ_FORMAT)
    schema = C.table(spark, d, "orders").schema
    return S.load_csv(spark, path, schema, ["o_orderkey", "o_custkey"])


def src2_load_transactions(spark, d):
    root = _folder(spark)
    tx = C.transactions(spark, d).select(*TX_COLUMNS)
    S.save(tx, f"{root}/raw/Fraud_Data.csv", "csv", timestampNTZFormat=NTZ_FORMAT)
    return S.load_transactions(spark, root)


def src3_load_bank(spark, d):
    root = _folder(spark)
    S.save(C.bank(spark, d).drop("l_orderkey", "l_linenumber"), f"{root}/raw/creditcard.csv", "csv")
    return S.load_bank(spark, root)


def src4_load_ip_ranges(spark, d):
    root = _folder(spark)
    S.save(C.ip_ranges(spark, d), f"{root}/raw/IpAddress_to_Country.csv", "csv")
    return S.load_ip_ranges(spark, root)


def snk1_save_and_read(spark, d):
    path = f"{_folder(spark)}/tx.parquet"
    tx = C.transactions(spark, d).withColumn("purchase_date", F.to_date("purchase_time").cast("string"))
    S.save(tx, path, partition_by=["purchase_date"])
    return S.load_parquet(spark, path, TX_COLUMNS).groupBy(F.col("purchase_date").cast("string").alias("purchase_date")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("class").alias("fraud_count")
    )


def snk2_stages(spark, d):
    stages = etl.run_stages(
        C.transactions(spark, d), C.ip_ranges(spark, d), key=["event_id"], out=_folder(spark)
    )
    return etl.stage_sizes(spark, stages)


def val1_check_table(spark, d):
    return S.check_table(C.dirty_transactions(spark, d), 10, ["event_id", "source"], True)


def val3_check_target(spark, d):
    return S.check_target(C.transactions(spark, d), "class")


QUERIES = {
    "src1_load_csv": (src1_load_csv, "select * from orders"),
    "src2_load_transactions": (
        src2_load_transactions,
        with_ctes(TX, f"select {', '.join(TX_COLUMNS)} from tx"),
    ),
    "src3_load_bank": (
        src3_load_bank,
        with_ctes(BANK, 'select "Time", "V1", "V2", "V3", "V4", "Amount", "Class" from bank'),
    ),
    "src4_load_ip_ranges": (
        src4_load_ip_ranges,
        with_ctes(RANGES, "select lo as lower_bound_ip_address, hi as upper_bound_ip_address, country from ranges"),
    ),
    "snk1_save_and_read": (
        snk1_save_and_read,
        with_ctes(
            TX,
            "select strftime(purchase_time, '%Y-%m-%d') as purchase_date, count(*) as n,"
            " cast(sum(class) as bigint) as fraud_count from tx group by 1",
        ),
    ),
    "snk2_stages": (snk2_stages, None),
    "val1_check_table": (
        val1_check_table,
        with_ctes(
            DIRTY,
            "select true as enough_rows, cast(sum(n) - count(*) as bigint) as duplicate_count from"
            " (select count(*) as n from dirty group by event_id, user_id, signup_time, purchase_text, purchase_value,"
            " source, device_id, class_text, class)",
        ),
    ),
    "val3_check_target": (
        val3_check_target,
        with_ctes(
            TX,
            "select count(*) as n_rows, count(*) filter (class is null) as null_targets,"
            " count(distinct class) as distinct_labels, count(distinct class) <= 2 as is_binary from tx",
        ),
    ),
}
