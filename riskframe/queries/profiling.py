"""Queries on group-by profiles, distributions, correlations, and risk findings."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.scalar import hours_between
from riskframe.operators import features, geo, profile, resample, risk
from riskframe.queries.base import BANK, GEO, TX, rounded, union_sql, with_ctes
from riskframe.sources import canonical as C

HOURS = "date_diff('microsecond', signup_time, purchase_time) / 3600000000.0"


def _tx(spark, d):
    return C.transactions(spark, d)


def _geo(spark, d):
    return geo.map_ip(_tx(spark, d), C.ip_ranges(spark, d))


# --- group risk ---------------------------------------------------------------


def agg1_device_risk(spark, d):
    return rounded(profile.group_risk(_tx(spark, d), "device_id"))


def agg1_source_risk(spark, d):
    return rounded(profile.group_risk(_tx(spark, d), "source"))


def agg2_device_min_rows(spark, d):
    return rounded(profile.group_risk(_tx(spark, d), "device_id", min_rows=100))


def agg3_rate_against_overall(spark, d):
    tx = _tx(spark, d)
    groups = profile.group_risk(tx, "browser").withColumn("overall_fraud_rate", profile.overall_rate(tx))
    return rounded(groups.withColumn("ratio", F.col("fraud_rate") / F.col("overall_fraud_rate")))


def risk_sql(ctes: str, key: str, table: str = "tx", min_rows: int = 0, factor: int = 1) -> str:
    return with_ctes(
        ctes,
        f"select {key}, count(class) as total_transactions, cast(sum(class) as bigint) as fraud_count,"
        f" round(avg(class) * {factor}, 6) as fraud_rate from {table} where {key} is not null group by {key}"
        f" having count(class) >= {min_rows}",
    )


def agg4_label_distribution(spark, d):
    return rounded(profile.label_distribution(_tx(spark, d)))


def agg4_label_distribution_bank(spark, d):
    return rounded(profile.label_distribution(C.bank(spark, d), "Class", "banking"))


def distribution_sql(table: str, label: str, dataset: str, name: str | None = None) -> str:
    n0, n1 = f'count(*) filter ("{label}" = 0)', f'count(*) filter ("{label}" = 1)'
    extra = "when r > 100 then 'EXTREME' " if dataset == "banking" else ""
    first = f"'{name}' as dataset, " if name else ""
    return (
        f"select {first}n0 as normal_count, n1 as fraud_count, round(n0 / n * 100, 6) as normal_percent,"
        " round(n1 / n * 100, 6) as fraud_percent, round(r, 6) as imbalance_ratio,"
        f" case {extra}when r > 10 then 'SEVERE' when r > 5 then 'MODERATE' else 'BALANCED' end as severity from"
        f' (select count("{label}") as n, {n0} as n0, {n1} as n1,'
        f" case when {n1} > 0 then {n0} / {n1} else 0 end as r from {table})"
    )


def agg5_value_counts(spark, d):
    return profile.value_counts(_tx(spark, d), ["source", "browser", "sex", "device_id"])


def agg5_hour_counts(spark, d):
    tx = features.time_features(_tx(spark, d))
    return profile.value_counts(tx, ["purchase_hour", "signup_hour", "day_of_week"])


def agg5_distinct_counts(spark, d):
    return profile.distinct_counts(_tx(spark, d), ["source", "browser", "sex", "device_id", "user_id"])


def agg6_crosstab(spark, d):
    return rounded(profile.crosstab(_tx(spark, d), "source"))


def agg6_crosstab_hour(spark, d):
    return rounded(profile.crosstab(features.time_features(_tx(spark, d)), "purchase_hour"))


# --- correlations -------------------------------------------------------------

CORR_COLUMNS = ("purchase_value", "age", "time_to_purchase", "class")
BANK_COLUMNS = ("Time", "V1", "V2", "V3", "V4", "Amount")


def agg7_correlations(spark, d):
    tx = _tx(spark, d).withColumn("time_to_purchase", hours_between("signup_time", "purchase_time"))
    return rounded(profile.correlations(tx, CORR_COLUMNS))


def agg8_top_correlated(spark, d):
    return rounded(profile.top_correlated(C.bank(spark, d), BANK_COLUMNS, "Class", 3))


def agg8_top_matrix(spark, d):
    return rounded(profile.top_correlation_matrix(C.wide_features(spark, d), [f"f{j}" for j in range(C.DIMS)], "Class", 4))


def _corr_sql() -> str:
    parts = [
        f"select '{a}' as feature_a, '{b}' as feature_b, round(corr({a}, {b}), 6) as correlation from c"
        for a in CORR_COLUMNS
        for b in CORR_COLUMNS
    ]
    return with_ctes(TX + f", c as (select *, {HOURS} as time_to_purchase from tx)", union_sql(parts))


def _top_corr_sql() -> str:
    parts = [f"select '{c}' as feature, corr(\"{c}\", \"Class\") as v from bank" for c in BANK_COLUMNS]
    return with_ctes(
        BANK,
        "select feature, round(v, 6) as correlation, round(abs(v), 6) as abs_correlation from"
        f" ({union_sql(parts)}) order by abs(v) desc, feature limit 3",
    )


def _top_matrix_sql() -> str:
    names = [f"f{j}" for j in range(64)]
    cols = ", ".join(f"cast(embedding[{j + 1}] as double) as f{j}" for j in range(64))
    cte = f'w as (select vec_id, {cols}, case when label = 0 then 1.0 else 0.0 end as "Class" from embeddings)'
    long = f'l as (unpivot w on {", ".join(names)}, "Class" into name feature value v)'
    label = 'y as (select vec_id, "Class" as yv from w)'
    top = (
        "t as (select feature from l join y using (vec_id) where feature <> 'Class' group by feature"
        " order by abs(corr(v, yv)) desc, feature limit 4)"
    )
    kept = "k as (select * from l where feature in (select feature from t) or feature = 'Class')"
    return with_ctes(
        ", ".join([cte, long, label, top, kept]),
        "select a.feature as feature_a, b.feature as feature_b, round(corr(a.v, b.v), 6) as correlation"
        " from k a join k b using (vec_id) group by a.feature, b.feature",
    )


# --- summaries ----------------------------------------------------------------


def agg9_describe(spark, d):
    return rounded(profile.describe(_tx(spark, d), ["purchase_value", "age", "ip_address"]))


def agg9_describe_bank(spark, d):
    # means of two-decimal amounts often end in ...5 at the seventh place: compare at four
    return rounded(profile.describe(C.bank(spark, d), BANK_COLUMNS), 4)


def agg9_describe_text(spark, d):
    return profile.describe_text(_tx(spark, d), ["source", "browser", "sex", "device_id"])


def agg10_describe_by_label(spark, d):
    tx = _tx(spark, d).withColumn("time_to_purchase", hours_between("signup_time", "purchase_time"))
    return rounded(profile.describe(tx, ["purchase_value", "age", "time_to_purchase"], ["class"]))


def agg11_mean_median(spark, d):
    tx = _tx(spark, d).withColumn("time_to_purchase", hours_between("signup_time", "purchase_time"))
    return rounded(profile.mean_median_by_label(tx, ["purchase_value", "age", "time_to_purchase"]))


def describe_sql(ctes: str, table: str, cols, by: str = "", decimals: int = 6) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"select {by + ', ' if by else ''}'{c}' as column_name, count(v) as count, round(avg(v), {decimals}) as mean,"
            f" round(stddev_samp(v), {decimals}) as std, round(min(v), {decimals}) as min,"
            f" round(quantile_cont(v, 0.25), {decimals}) as q25, round(quantile_cont(v, 0.5), {decimals}) as q50,"
            f" round(quantile_cont(v, 0.75), {decimals}) as q75, round(max(v), {decimals}) as max"
            f" from (select *, cast(\"{c}\" as double) as v from {table}){' group by ' + by if by else ''}"
        )
    return with_ctes(ctes, union_sql(parts))


TIMED = TX + f", timed as (select *, {HOURS} as time_to_purchase from tx)"


def _mean_median_sql() -> str:
    parts = [
        f"select class, '{c}' as column_name, round(avg({c}), 6) as mean, round(quantile_cont(cast({c} as double), 0.5), 6)"
        " as median from timed group by class"
        for c in ("purchase_value", "age", "time_to_purchase")
    ]
    return with_ctes(TIMED, union_sql(parts))


def _describe_text_sql() -> str:
    parts = []
    for c in ("source", "browser", "sex", "device_id"):
        parts.append(
            f"select '{c}' as column_name, (select count({c}) from tx) as count, (select count(distinct {c}) from tx)"
            f" as n_distinct, v as top, n as freq from (select {c} as v, count(*) as n from tx group by {c}"
            f" order by n desc, v limit 1)"
        )
    return with_ctes(TX, union_sql(parts))


# --- histograms, boxes, bins --------------------------------------------------


def agg12_histogram(spark, d):
    return rounded(profile.histogram(_tx(spark, d), {"purchase_value": 50, "age": 50}))


def agg12_histogram_by_label(spark, d):
    return rounded(profile.histogram(_tx(spark, d), {"purchase_value": 50, "age": 30}, ["class"]))


def histogram_sql(bins: dict, by: str = "") -> str:
    b = f"{by}, " if by else ""
    part = f"partition by {by}" if by else ""
    parts = []
    for c, n in bins.items():
        grouped = f"select {b}min(cast({c} as double)) as lo, max(cast({c} as double)) as hi from tx {'group by ' + by if by else ''}"
        on = f"g.{by} = k.{by} and " if by else ""
        parts.append(
            f"select {'g.' + b if by else ''}'{c}' as column_name, cast(g.bin as int) as bin,"
            f" round(lo + (hi - lo) / {n} * g.bin, 6) as bin_low, round(lo + (hi - lo) / {n} * (g.bin + 1), 6) as bin_high,"
            f" coalesce(k.n, 0) as n from (select * from ({grouped}), (select unnest(range({n})) as bin)) g left join"
            f" (select {b}bin, count(*) as n from (select {b}least(floor((cast({c} as double) - lo) / (hi - lo) * {n}), {n - 1}) as bin from"
            f" (select {b}{c}, min(cast({c} as double)) over ({part}) as lo, max(cast({c} as double)) over ({part}) as hi from tx))"
            f" group by {b}bin) k on {on}g.bin = k.bin"
        )
    return with_ctes(TX, union_sql(parts))


def agg13_box_stats(spark, d):
    return rounded(profile.box_stats(_tx(spark, d), ["purchase_value"], ["class"]))


def agg13_box_stats_bank(spark, d):
    return rounded(profile.box_stats(C.bank(spark, d), ["Amount", "Time"], ["Class"]))


def box_sql(ctes: str, table: str, cols, by: str) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"select s.\"{by}\", '{c}' as column_name, round(q1, 6) as q1, round(median, 6) as median, round(q3, 6) as q3,"
            f" round(min(v) filter (v >= q1 - 1.5 * (q3 - q1) and v <= q3 + 1.5 * (q3 - q1)), 6) as whisker_low,"
            f" round(max(v) filter (v >= q1 - 1.5 * (q3 - q1) and v <= q3 + 1.5 * (q3 - q1)), 6) as whisker_high,"
            " count(*) filter (not (v >= q1 - 1.5 * (q3 - q1) and v <= q3 + 1.5 * (q3 - q1))) as outliers"
            f" from (select \"{by}\", cast(\"{c}\" as double) as v from {table}) s join (select \"{by}\","
            f" quantile_cont(\"{c}\", 0.25) as q1, quantile_cont(\"{c}\", 0.5) as median, quantile_cont(\"{c}\", 0.75) as q3"
            f" from {table} group by \"{by}\") q on s.\"{by}\" = q.\"{by}\" group by s.\"{by}\", q1, median, q3"
        )
    return with_ctes(ctes, union_sql(parts))


def agg14_rate_by_signup_bin(spark, d):
    return rounded(profile.rate_by_bin(features.time_features(_tx(spark, d))))


BINNED = (
    TX
    + f""", binned as (select class, case when h > 0 and h <= 1 then '0-1h' when h > 1 and h <= 24 then '1-24h'
  when h > 24 and h <= 168 then '24-168h' when h > 168 then '>168h' end as time_bin
  from (select class, {HOURS} as h from tx))"""
)


# --- geography ----------------------------------------------------------------


def agg15_country_profile(spark, d):
    return rounded(profile.group_risk(_geo(spark, d), "country", percent=True))


def agg15_top_countries_by_rate(spark, d):
    return rounded(profile.top_groups(_geo(spark, d), "country", 15, "fraud_rate", min_rows=100))


def agg15_top_countries_by_fraud(spark, d):
    return rounded(profile.top_groups(_geo(spark, d), "country", 15, "fraud_count"))


def agg15_top_countries_by_volume(spark, d):
    return rounded(profile.top_groups(_geo(spark, d), "country", 15, "total_transactions"))


def top1_lowest_rate_devices(spark, d):
    return rounded(profile.top_groups(_tx(spark, d), "device_id", 10, "fraud_rate", min_rows=5, ascending=True))


def top_sql(ctes: str, key: str, table: str, n: int, order: str, min_rows: int = 0, direction: str = "desc") -> str:
    return with_ctes(
        ctes,
        f"select {key}, total_transactions, fraud_count, round(fraud_rate, 6) as fraud_rate from (select {key},"
        " count(class) as total_transactions, cast(sum(class) as bigint) as fraud_count, avg(class) * 100 as fraud_rate"
        f" from {table} group by {key} having count(class) >= {min_rows}) order by {order} {direction}, {key} limit {n}",
    )


def agg16_country_levels(spark, d):
    return rounded(profile.geo_risk(_geo(spark, d)))


def agg16_device_levels(spark, d):
    return rounded(profile.geo_risk(_tx(spark, d), "device_id", min_rows=5))


def agg16_user_levels(spark, d):
    return rounded(profile.geo_risk(_tx(spark, d), "user_id", min_rows=50))


def levels_sql(ctes: str, key: str, table: str, min_rows: int) -> str:
    return with_ctes(
        ctes,
        f"select * replace (round(fraud_rate, 6) as fraud_rate, round(risk_ratio, 6) as risk_ratio) from (select *,"
        " case when risk_ratio > 3 then 'CRITICAL' when risk_ratio > 2 then 'HIGH' when risk_ratio < 0.5 then 'LOW' end"
        f" as risk_level from (select {key}, count(class) as total_transactions, cast(sum(class) as bigint) as fraud_count,"
        f" avg(class) * 100 as fraud_rate, avg(class) * 100 / ((select avg(class) from {table}) * 100) as risk_ratio"
        f" from {table} group by {key} having count(class) >= {min_rows})) where risk_level is not null",
    )


def agg17_compare_datasets(spark, d):
    return rounded(
        profile.compare_distributions(
            {
                "ecommerce": (_tx(spark, d), "class", "ecommerce"),
                "banking": (C.bank(spark, d), "Class", "banking"),
            }
        )
    )


def agg18_distribution_change(spark, d):
    tx = _tx(spark, d)
    return rounded(profile.distribution_change(tx, resample.undersample(tx, ["event_id"], ratio=0.5)))


# --- risk findings ------------------------------------------------------------


def rsk1_amount(spark, d):
    return rounded(risk.amount(_tx(spark, d)))


def rsk2_device(spark, d):
    return rounded(risk.device(_tx(spark, d)))


def rsk2_device_groups(spark, d):
    return rounded(risk.key_groups(_tx(spark, d), "device_id", min_rows=5, kind="device"))


def rsk2_device_report(spark, d):
    return rounded(risk.key_groups(_tx(spark, d), "device_id", min_rows=5, kind="device", top_n=10))


def rsk3_source(spark, d):
    return rounded(risk.source(_tx(spark, d)))


def rsk4_browser(spark, d):
    return rounded(risk.browser(_tx(spark, d)))


def rsk5_summary(spark, d):
    return rounded(risk.summary(_tx(spark, d)))


def sta1_mann_whitney(spark, d):
    return rounded(risk.mann_whitney(_tx(spark, d), "purchase_value", p_value=False))


def sta1_mann_whitney_bank(spark, d):
    return rounded(risk.mann_whitney(C.bank(spark, d), "V1", "Class", p_value=False))


def sta1_p_value(spark, d):
    return rounded(risk.mann_whitney(_tx(spark, d), "age"))


AMOUNT_SQL = (
    "select *, case when risk_ratio > 1.5 then 'HIGH'"
    " when risk_ratio > 1.2 then 'MODERATE' else 'LOW' end as risk_level from (select fm as fraud_mean, nm as normal_mean,"
    " fmed as fraud_median, nmed as normal_median, case when nm > 0 then fm / nm else 0 end as risk_ratio from (select"
    " avg(purchase_value) filter (class = 1) as fm, avg(purchase_value) filter (class = 0) as nm,"
    " quantile_cont(purchase_value, 0.5) filter (class = 1) as fmed, quantile_cont(purchase_value, 0.5) filter (class = 0)"
    " as nmed from tx))"
)


def by_key_sql(key: str, critical: float, high: float, min_rows: int = 0, top_n: int | None = None) -> str:
    rate = "case when k > 0 then top_rate else 0.0 end" if top_n else "top_rate"
    return (
        f"select o as overall_fraud_rate, cast(k as bigint) as high_risk_count, {rate} as max_fraud_rate,"
        f" case when k = 0 then 'LOW' when top_rate > o * {critical} then 'CRITICAL' when top_rate > o * {high} then 'HIGH'"
        " else 'MODERATE' end as risk_level from (select max(o) as o, count(*) filter (r > o * 1.5) as k, max(r) as top_rate"
        f" from (select avg(class) as r, (select avg(class) from tx) as o from tx group by {key}"
        f" having count(class) >= {min_rows}))"
    )


def _rounded_key_sql(key, critical, high, min_rows=0, top_n=None) -> str:
    inner = by_key_sql(key, critical, high, min_rows, top_n)
    return with_ctes(
        TX,
        "select * replace (round(overall_fraud_rate, 6) as overall_fraud_rate, round(max_fraud_rate, 6) as max_fraud_rate)"
        f" from ({inner})",
    )


def _groups_sql(tail: str = "") -> str:
    return with_ctes(
        TX,
        "select device_id, total_transactions, fraud_count, round(r, 6) as fraud_rate, round(o, 6) as overall_fraud_rate,"
        " round(r / o, 6) as risk_ratio from (select device_id, count(class) as total_transactions, cast(sum(class) as bigint)"
        " as fraud_count, avg(class) as r, (select avg(class) from tx) as o from tx group by device_id"
        f" having count(class) >= 5) where r > o * 1.5 {tail}",
    )


def _summary_sql() -> str:
    parts = [f"select 'amount' as factor, risk_ratio as measure, risk_level from ({AMOUNT_SQL})"]
    for factor, key, critical, high, rows, top in (
        ("device", "device_id", 3, 2, 5, 10),
        ("source", "source", 3, 2, 0, None),
        ("browser", "browser", 2.5, 1.8, 0, None),
    ):
        parts.append(
            f"select '{factor}', max_fraud_rate, risk_level from ({by_key_sql(key, critical, high, rows, top)})"
        )
    return with_ctes(
        TX,
        "select factor, round(measure, 6) as measure, risk_level, risk_level in ('CRITICAL', 'HIGH') as is_priority,"
        " (select round(avg(class), 6) from tx) as overall_fraud_rate, (select count(*) from tx) as total_transactions,"
        " (select cast(sum(class) as bigint) from tx) as fraud_cases, (select count(*) filter (class = 0) from tx)"
        f" as normal_cases from ({union_sql(parts)})",
    )


# two-sided normal tail 1 - erf(|z| / sqrt 2), with erf as its power series
TAIL = (
    "1 - 2 / sqrt(pi()) * list_sum(list_transform(range(0, 40), lambda k: pow(-1, k) * pow(z / sqrt(2.0), 2 * k + 1)"
    " / (gamma(k + 1) * (2 * k + 1))))"
)


def mann_whitney_sql(ctes: str, table: str, value: str, label: str, p_value: bool = False) -> str:
    tail = f", round(least(1.0, {TAIL}), 6) as p_value" if p_value else ""
    return with_ctes(
        ctes
        + f""", counts as (select "{value}" as v, count(*) as n, sum("{label}") as pos from {table} where "{value}" is not null group by 1),
  ranked as (select *, sum(n) over (order by v rows between unbounded preceding and current row) - n as below from counts),
  sums as (select cast(sum(pos) as double) as n1, cast(sum(n) - sum(pos) as double) as n0,
    sum(pos * (below + (n + 1) / 2)) as r1, sum(cast(n as double) * n * n - n) as ties from ranked),
  stat as (select n1, n0, r1 - n1 * (n1 + 1) / 2 as u,
    sqrt(n1 * n0 / 12 * ((n1 + n0 + 1) - ties / ((n1 + n0) * (n1 + n0 - 1)))) as s from sums)""",
        f"select cast(n1 as bigint) as n1, cast(n0 as bigint) as n0, round(u, 6) as u_statistic, round(z, 6) as z{tail}"
        " from (select *, (greatest(u, n1 * n0 - u) - n1 * n0 / 2 - 0.5) / s as z from stat)",
    )


QUERIES = {
    "agg1_device_risk": (agg1_device_risk, risk_sql(TX, "device_id")),
    "agg1_source_risk": (agg1_source_risk, risk_sql(TX, "source")),
    "agg2_device_min_rows": (agg2_device_min_rows, risk_sql(TX, "device_id", min_rows=100)),
    "agg3_rate_against_overall": (
        agg3_rate_against_overall,
        with_ctes(
            TX,
            "select browser, count(class) as total_transactions, cast(sum(class) as bigint) as fraud_count,"
            " round(avg(class), 6) as fraud_rate, (select round(avg(class), 6) from tx) as overall_fraud_rate,"
            " round(avg(class) / (select avg(class) from tx), 6) as ratio from tx group by browser",
        ),
    ),
    "agg4_label_distribution": (agg4_label_distribution, with_ctes(TX, distribution_sql("tx", "class", "ecommerce"))),
    "agg4_label_distribution_bank": (
        agg4_label_distribution_bank,
        with_ctes(BANK, distribution_sql("bank", "Class", "banking")),
    ),
    "agg5_value_counts": (
        agg5_value_counts,
        with_ctes(
            TX,
            union_sql(
                [
                    f"select '{c}' as column_name, {c} as value, count(*) as n from tx group by {c}"
                    for c in ("source", "browser", "sex", "device_id")
                ]
            ),
        ),
    ),
    "agg5_hour_counts": (
        agg5_hour_counts,
        with_ctes(
            TX,
            union_sql(
                [
                    f"select '{name}' as column_name, cast({e} as varchar) as value, count(*) as n from tx group by 2"
                    for name, e in (
                        ("purchase_hour", "hour(purchase_time)"),
                        ("signup_hour", "hour(signup_time)"),
                        ("day_of_week", "isodow(purchase_time) - 1"),
                    )
                ]
            ),
        ),
    ),
    "agg5_distinct_counts": (
        agg5_distinct_counts,
        with_ctes(
            TX,
            union_sql(
                [
                    f"select '{c}' as column_name, count(distinct {c}) as n_distinct from tx"
                    for c in ("source", "browser", "sex", "device_id", "user_id")
                ]
            ),
        ),
    ),
    "agg6_crosstab": (
        agg6_crosstab,
        with_ctes(
            TX,
            "select source, count(*) filter (class = 0) as n_0, count(*) filter (class = 1) as n_1, count(class) as n_total,"
            " round(count(*) filter (class = 0) / count(class) * 100, 6) as pct_0,"
            " round(count(*) filter (class = 1) / count(class) * 100, 6) as pct_1 from tx group by source",
        ),
    ),
    "agg6_crosstab_hour": (
        agg6_crosstab_hour,
        with_ctes(
            TX,
            "select cast(hour(purchase_time) as int) as purchase_hour, count(*) filter (class = 0) as n_0,"
            " count(*) filter (class = 1) as n_1, count(class) as n_total,"
            " round(count(*) filter (class = 0) / count(class) * 100, 6) as pct_0,"
            " round(count(*) filter (class = 1) / count(class) * 100, 6) as pct_1 from tx group by 1",
        ),
    ),
    "agg7_correlations": (agg7_correlations, _corr_sql()),
    "agg8_top_correlated": (agg8_top_correlated, _top_corr_sql()),
    "agg8_top_matrix": (agg8_top_matrix, _top_matrix_sql()),
    "agg9_describe": (agg9_describe, describe_sql(TX, "tx", ("purchase_value", "age", "ip_address"))),
    "agg9_describe_bank": (agg9_describe_bank, describe_sql(BANK, "bank", BANK_COLUMNS, decimals=4)),
    "agg9_describe_text": (agg9_describe_text, _describe_text_sql()),
    "agg10_describe_by_label": (
        agg10_describe_by_label,
        describe_sql(TIMED, "timed", ("purchase_value", "age", "time_to_purchase"), "class"),
    ),
    "agg11_mean_median": (agg11_mean_median, _mean_median_sql()),
    "agg12_histogram": (agg12_histogram, histogram_sql({"purchase_value": 50, "age": 50})),
    "agg12_histogram_by_label": (
        agg12_histogram_by_label,
        histogram_sql({"purchase_value": 50, "age": 30}, "class"),
    ),
    "agg13_box_stats": (agg13_box_stats, box_sql(TX, "tx", ("purchase_value",), "class")),
    "agg13_box_stats_bank": (agg13_box_stats_bank, box_sql(BANK, "bank", ("Amount", "Time"), "Class")),
    "agg14_rate_by_signup_bin": (agg14_rate_by_signup_bin, risk_sql(BINNED, "time_bin", "binned", factor=100)),
    "agg15_country_profile": (agg15_country_profile, risk_sql(GEO, "country", "geo", factor=100)),
    "agg15_top_countries_by_rate": (
        agg15_top_countries_by_rate,
        top_sql(GEO, "country", "geo", 15, "fraud_rate", 100),
    ),
    "agg15_top_countries_by_fraud": (
        agg15_top_countries_by_fraud,
        top_sql(GEO, "country", "geo", 15, "fraud_count"),
    ),
    "agg15_top_countries_by_volume": (
        agg15_top_countries_by_volume,
        top_sql(GEO, "country", "geo", 15, "total_transactions"),
    ),
    "top1_lowest_rate_devices": (
        top1_lowest_rate_devices,
        top_sql(TX, "device_id", "tx", 10, "fraud_rate", 5, "asc"),
    ),
    "agg16_country_levels": (agg16_country_levels, levels_sql(GEO, "country", "geo", 100)),
    "agg16_device_levels": (agg16_device_levels, levels_sql(TX, "device_id", "tx", 5)),
    "agg16_user_levels": (agg16_user_levels, levels_sql(TX, "user_id", "tx", 50)),
    "agg17_compare_datasets": (
        agg17_compare_datasets,
        with_ctes(
            TX + ", " + BANK,
            union_sql(
                [
                    distribution_sql("tx", "class", "ecommerce", "ecommerce"),
                    distribution_sql("bank", "Class", "banking", "banking"),
                ]
            ),
        ),
    ),
    "agg18_distribution_change": (
        agg18_distribution_change,
        with_ctes(
            TX
            + """, b as (select class, count(*) as n from tx group by class),
  f as (select n from b where class = 1),
  a as (select class, case when class = 1 then n else cast(floor((select n from f) / 0.5) as bigint) end as m from b)""",
            "select class, n as count_before, round(n / (select sum(n) from b) * 100, 6) as percent_before,"
            " m as count_after, round(m / (select sum(m) from a) * 100, 6) as percent_after, m - n as change"
            " from a join b using (class)",
        ),
    ),
    "rsk1_amount": (
        rsk1_amount,
        with_ctes(
            TX,
            "select round(fraud_mean, 6) as fraud_mean, round(normal_mean, 6) as normal_mean, round(fraud_median, 6)"
            " as fraud_median, round(normal_median, 6) as normal_median, round(risk_ratio, 6) as risk_ratio, risk_level"
            f" from ({AMOUNT_SQL})",
        ),
    ),
    "rsk2_device": (rsk2_device, _rounded_key_sql("device_id", 3, 2, 5, 10)),
    "rsk2_device_groups": (rsk2_device_groups, _groups_sql()),
    "rsk2_device_report": (
        rsk2_device_report,
        _groups_sql("order by r desc, total_transactions desc, device_id limit 10"),
    ),
    "rsk3_source": (rsk3_source, _rounded_key_sql("source", 3, 2)),
    "rsk4_browser": (rsk4_browser, _rounded_key_sql("browser", 2.5, 1.8)),
    "rsk5_summary": (rsk5_summary, _summary_sql()),
    "sta1_mann_whitney": (sta1_mann_whitney, mann_whitney_sql(TX, "tx", "purchase_value", "class")),
    "sta1_mann_whitney_bank": (sta1_mann_whitney_bank, mann_whitney_sql(BANK, "bank", "V1", "Class")),
    "sta1_p_value": (sta1_p_value, mann_whitney_sql(TX, "tx", "age", "class", p_value=True)),
}
