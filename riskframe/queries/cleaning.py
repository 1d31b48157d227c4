"""Queries on missing values, duplicates, types and column selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.operators import clean
from riskframe.queries.base import BANK, DIRTY, TX, rounded, union_sql, with_ctes
from riskframe.sources import canonical as C

DIRTY_COLUMNS = (
    "event_id", "user_id", "signup_time", "purchase_text", "purchase_value", "source", "device_id", "class_text", "class",
)
MODE_SOURCE = "(select source from dirty where source is not null group by source order by count(*) desc, source limit 1)"
MEDIAN_VALUE = "(select quantile_cont(purchase_value, 0.5) from dirty)"

GAPS = (
    TX
    + """, gaps as (
  select event_id, user_id, case when event_id % 97 <> 0 then purchase_value end as purchase_value,
    case when event_id % 89 <> 0 then source end as source from tx)"""
)


def _gaps(spark, d):
    return C.transactions(spark, d).select(
        "event_id",
        "user_id",
        F.when(F.col("event_id") % 97 != 0, F.col("purchase_value")).alias("purchase_value"),
        F.when(F.col("event_id") % 89 != 0, F.col("source")).alias("source"),
    )


def cln1_drop_nulls(spark, d):
    return clean.handle_missing(C.dirty_transactions(spark, d), "drop", ["purchase_value", "source"])


def cln2_fill_constant(spark, d):
    return clean.handle_missing(C.dirty_transactions(spark, d), "fill", ["purchase_value"], fill_value=0.0)


def cln3_fill_median_mode(spark, d):
    return rounded(clean.handle_missing(C.dirty_transactions(spark, d), "fill", ["purchase_value", "source"]))


def cln4_fill_with_unknown(spark, d):
    df = C.dirty_transactions(spark, d).withColumn("note", F.lit(None).cast("string"))
    return rounded(clean.handle_missing(df, "fill", fallback="Unknown"))


def cln5_forward_fill(spark, d):
    return clean.handle_missing(_gaps(spark, d), "forward_fill", ["purchase_value", "source"], order_by="event_id")


def cln5_forward_fill_per_user(spark, d):
    return clean.handle_missing(
        _gaps(spark, d), "forward_fill", ["purchase_value", "source"], order_by="event_id", partition_by=["user_id"]
    )


def _fill_sql(part: str) -> str:
    cols = []
    for c in ("purchase_value", "source"):
        back = f"last_value({c} ignore nulls) over ({part} order by event_id rows between unbounded preceding and current row)"
        ahead = f"first_value({c} ignore nulls) over ({part} order by event_id rows between current row and unbounded following)"
        cols.append(f"coalesce({back}, {ahead}) as {c}")
    return with_ctes(GAPS, f"select event_id, user_id, {', '.join(cols)} from gaps")


def cln6_null_profile(spark, d):
    return rounded(clean.null_profile(C.dirty_transactions(spark, d)))


def _null_sql() -> str:
    parts = [
        f"select '{c}' as column_name, count(*) filter ({c} is null) as missing_count,"
        f" round(count(*) filter ({c} is null) / count(*) * 100, 6) as missing_percent from dirty"
        for c in DIRTY_COLUMNS
    ]
    return with_ctes(DIRTY, f"select * from ({union_sql(parts)}) where missing_count > 0")


def cln7_keep_first(spark, d):
    return clean.remove_duplicates(C.transactions(spark, d), ["user_id", "source"], "first", "event_id")


def cln7_keep_last(spark, d):
    return clean.remove_duplicates(C.transactions(spark, d), ["device_id", "browser"], "last", "event_id")


def cln7_keep_none(spark, d):
    return clean.remove_duplicates(C.transactions(spark, d), ["user_id", "device_id"], False)


def cln7_full_rows(spark, d):
    return clean.remove_duplicates(C.dirty_transactions(spark, d))


def cln8_duplicate_stats(spark, d):
    return rounded(clean.duplicate_stats(C.dirty_transactions(spark, d)))


def cln9_conflicting_duplicates(spark, d):
    return clean.conflicting_duplicates(C.dirty_transactions(spark, d), "class")


def cln10_to_datetime(spark, d):
    df = C.dirty_transactions(spark, d).select("event_id", "purchase_text", "class")
    return clean.to_datetime(df, ["purchase_text"])


def cln11_drop_bad_datetimes(spark, d):
    df = clean.to_datetime(C.dirty_transactions(spark, d), ["purchase_text"])
    return clean.drop_bad_datetimes(df.select("event_id", "signup_time", "purchase_text", "class"), ["signup_time", "purchase_text"])


def _numbers_as_text(spark, d):
    return C.transactions(spark, d).select(
        "event_id",
        F.when(F.col("event_id") % 53 == 0, "n/a").otherwise(F.concat(F.col("age").cast("string"), F.lit(".5"))).alias("amount"),
        F.when(F.col("event_id") % 59 == 0, "").otherwise(F.col("user_id").cast("string")).alias("user"),
    )


def cln12_to_numeric(spark, d):
    return clean.to_numeric(clean.to_numeric(_numbers_as_text(spark, d), ["amount"]), ["user"], "bigint")


def cln13_clean_label(spark, d):
    df = C.dirty_transactions(spark, d).select(
        "event_id", F.when(F.col("event_id") % 61 == 0, "2").otherwise(F.col("class_text")).alias("label")
    )
    return clean.clean_label(df, "label")


def cln14_drop_null_target(spark, d):
    df = C.bank(spark, d).withColumns(
        {
            "Amount": F.when(F.col("l_orderkey") % 97 != 0, F.col("Amount")),
            "Class": F.when(F.col("l_orderkey") % 89 != 0, F.col("Class")),
        }
    )
    return clean.handle_missing(df, "drop", ["Class", "Time", "Amount"])


def cln15_fix_infinite(spark, d):
    value = (
        F.when(F.col("event_id") % 101 == 0, F.lit(float("inf")))
        .when(F.col("event_id") % 103 == 0, F.lit(float("-inf")))
        .otherwise(F.col("purchase_value"))
    )
    df = C.transactions(spark, d).select("event_id", value.alias("purchase_value"))
    return rounded(clean.fix_infinite(df, ["purchase_value"]))


def prj1_separate_features(spark, d):
    return clean.separate_features(C.transactions(spark, d), "ecommerce")


def prj1_bank_features(spark, d):
    return clean.separate_features(C.bank(spark, d), "banking")


def flt1_fraud_rows(spark, d):
    return C.transactions(spark, d).where(F.col("class") == 1)


_ALL = ", ".join(DIRTY_COLUMNS)

QUERIES = {
    "cln1_drop_nulls": (
        cln1_drop_nulls,
        with_ctes(DIRTY, "select * from dirty where purchase_value is not null and source is not null"),
    ),
    "cln2_fill_constant": (
        cln2_fill_constant,
        with_ctes(DIRTY, "select * replace (coalesce(purchase_value, 0.0) as purchase_value) from dirty"),
    ),
    "cln3_fill_median_mode": (
        cln3_fill_median_mode,
        with_ctes(
            DIRTY,
            f"select * replace (round(coalesce(purchase_value, {MEDIAN_VALUE}), 6) as purchase_value,"
            f" coalesce(source, {MODE_SOURCE}) as source) from dirty",
        ),
    ),
    "cln4_fill_with_unknown": (
        cln4_fill_with_unknown,
        with_ctes(
            DIRTY,
            f"select * replace (round(coalesce(purchase_value, {MEDIAN_VALUE}), 6) as purchase_value,"
            f" coalesce(source, {MODE_SOURCE}) as source), 'Unknown' as note from dirty",
        ),
    ),
    "cln5_forward_fill": (cln5_forward_fill, _fill_sql("")),
    "cln5_forward_fill_per_user": (cln5_forward_fill_per_user, _fill_sql("partition by user_id")),
    "cln6_null_profile": (cln6_null_profile, _null_sql()),
    "cln7_keep_first": (
        cln7_keep_first,
        with_ctes(TX, "select * from tx qualify row_number() over (partition by user_id, source order by event_id) = 1"),
    ),
    "cln7_keep_last": (
        cln7_keep_last,
        with_ctes(
            TX, "select * from tx qualify row_number() over (partition by device_id, browser order by event_id desc) = 1"
        ),
    ),
    "cln7_keep_none": (
        cln7_keep_none,
        with_ctes(TX, "select * from tx qualify count(*) over (partition by user_id, device_id) = 1"),
    ),
    "cln7_full_rows": (cln7_full_rows, with_ctes(DIRTY, "select distinct * from dirty")),
    "cln8_duplicate_stats": (
        cln8_duplicate_stats,
        with_ctes(
            DIRTY,
            "select cast(sum(n) as bigint) as total_rows, cast(sum(n) - count(*) as bigint) as duplicate_count,"
            " round((sum(n) - count(*)) / sum(n) * 100, 6) as duplicate_percent"
            f" from (select count(*) as n from dirty group by {_ALL})",
        ),
    ),
    "cln9_conflicting_duplicates": (
        cln9_conflicting_duplicates,
        with_ctes(
            DIRTY,
            f"select {', '.join(DIRTY_COLUMNS[:-1])}, count(*) as n_rows, min(class) as min_label, max(class) as max_label"
            f" from dirty group by {', '.join(DIRTY_COLUMNS[:-1])} having count(distinct class) > 1",
        ),
    ),
    "cln10_to_datetime": (
        cln10_to_datetime,
        with_ctes(DIRTY, "select event_id, try_cast(purchase_text as timestamp) as purchase_text, class from dirty"),
    ),
    "cln11_drop_bad_datetimes": (
        cln11_drop_bad_datetimes,
        with_ctes(
            DIRTY,
            "select event_id, signup_time, p as purchase_text, class from"
            " (select *, try_cast(purchase_text as timestamp) as p from dirty)"
            " where (p is not null and signup_time is not null) or (select count(*) filter"
            " (try_cast(purchase_text as timestamp) is null) + count(*) filter (signup_time is null)"
            " >= 0.01 * count(*) from dirty)",
        ),
    ),
    "cln12_to_numeric": (
        cln12_to_numeric,
        with_ctes(
            TX,
            "select event_id, try_cast(case when event_id % 53 = 0 then 'n/a' else concat(age, '.5') end as double) as amount,"
            ' try_cast(case when event_id % 59 = 0 then \'\' else cast(user_id as varchar) end as bigint) as "user" from tx',
        ),
    ),
    "cln13_clean_label": (
        cln13_clean_label,
        with_ctes(
            DIRTY,
            "select * from (select event_id, try_cast(replace(trim(case when event_id % 61 = 0 then '2' else class_text end),"
            " '\"', '') as int) as label from dirty) where label in (0, 1)",
        ),
    ),
    "cln14_drop_null_target": (
        cln14_drop_null_target,
        with_ctes(BANK, "select * from bank where l_orderkey % 97 <> 0 and l_orderkey % 89 <> 0"),
    ),
    "cln15_fix_infinite": (
        cln15_fix_infinite,
        with_ctes(
            TX,
            "select event_id, round(case when event_id % 101 = 0 or event_id % 103 = 0 then (select"
            " quantile_cont(purchase_value, 0.5) from tx where event_id % 101 <> 0 and event_id % 103 <> 0)"
            " else purchase_value end, 6) as purchase_value from tx",
        ),
    ),
    "prj1_separate_features": (
        prj1_separate_features,
        with_ctes(TX, "select event_id, purchase_value, device_id, source, browser, sex, age, class from tx"),
    ),
    "prj1_bank_features": (
        prj1_bank_features,
        with_ctes(BANK, 'select l_orderkey, l_linenumber, "V1", "V2", "V3", "V4", "Amount", "Class" from bank'),
    ),
    "flt1_fraud_rows": (flt1_fraud_rows, with_ctes(TX, "select * from tx where class = 1")),
}
