"""Queries on scalar functions, joins, windows, encoding, scaling, splitting, resampling."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions import scalar
from riskframe.operators import encode, features, geo, resample, scale, split
from riskframe.queries.base import (
    BANK,
    EVENT_KEY,
    GEO,
    RANGES,
    TX,
    hash32_sql,
    rounded,
    uniform_sql,
    union_sql,
    wide_cte,
    with_ctes,
)
from riskframe.sources import canonical as C

HOURS = "round(date_diff('microsecond', signup_time, purchase_time) / 3600000000.0, 6)"
DIMS = C.DIMS
DIM_NAMES = [f"f{j}" for j in range(DIMS)]


# --- scalar functions ---------------------------------------------------------


def scl1_hours_since_signup(spark, d):
    tx = C.transactions(spark, d)
    return rounded(tx.select("event_id", scalar.hours_between("signup_time", "purchase_time").alias("hours")))


def scl2_time_features(spark, d):
    tx = C.transactions(spark, d).select("event_id", "signup_time", "purchase_time")
    return rounded(features.time_features(tx).drop("signup_time", "purchase_time"))


TIME_SQL = (
    "select event_id, cast(hour(purchase_time) as int) as hour_of_day, cast(isodow(purchase_time) - 1 as int) as day_of_week, "
    + HOURS
    + " as time_since_signup, "
    + ", ".join(
        f"cast({part}({p}_time) as int) as {p}_{part}"
        for p in ("purchase", "signup")
        for part in ("hour", "day", "month", "year")
    )
    + " from tx"
)


def scl4_log1p(spark, d):
    return rounded(C.bank(spark, d).select("l_orderkey", "l_linenumber", F.log1p("Amount").alias("amount_log")))


def scl5_signup_bins(spark, d):
    tx = C.transactions(spark, d)
    hours = scalar.hours_between("signup_time", "purchase_time")
    return tx.select("event_id", scalar.right_closed_bin(hours).alias("time_bin"))


def scl6_normalise(spark, d):
    top = C.transactions(spark, d).agg(F.max(F.abs("purchase_value"))).scalar()
    value = F.col("purchase_value") - 50
    return rounded(
        C.transactions(spark, d).select(
            "event_id",
            F.abs(value).alias("absolute"),
            (F.col("purchase_value") / top).alias("max_normalised"),
            scalar.clamp01(value / 100).alias("clamped"),
        )
    )


def scl7_keyword_rules(spark, d):
    docs = C.table(spark, d, "documents")
    category = (
        F.when(scalar.contains_any("text", ["email", "phone"]), "contact")
        .when(scalar.contains_any("text", ["license", "copyright"]), "license")
        .otherwise("other")
    )
    return docs.select("doc_id", category.alias("category"))


def scl8_ip_integer(spark, d):
    return C.transactions(spark, d).select("event_id", F.col("ip_address").cast("bigint").alias("ip_address_int"))


# --- joins --------------------------------------------------------------------


def jon1_ip_range_join(spark, d):
    return geo.map_ip(C.transactions(spark, d), C.ip_ranges(spark, d))


def jon1_coverage(spark, d):
    return geo.coverage(geo.map_ip(C.transactions(spark, d), C.ip_ranges(spark, d)))


def jon2_ip_asof_join(spark, d):
    return geo.map_ip(C.transactions(spark, d), C.ip_ranges(spark, d), mode="asof").select(
        "event_id", "ip_address_int", "country"
    )


def jon3_ip_exact_join(spark, d):
    return geo.map_ip(C.transactions(spark, d), C.ip_ranges(spark, d), mode="exact").select(
        "event_id", "ip_address_int", "country"
    )


# --- windows ------------------------------------------------------------------


def win1_velocity_ties(spark, d):
    orders = C.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return features.velocity(orders, "o_custkey", "o_orderdate", ["24h", "30d"])


def win1_velocity(spark, d):
    tx = C.transactions(spark, d).select("event_id", "user_id", "purchase_time")
    return features.velocity(tx, windows=["1h", "24h", "7d", "30d"])


def win1_velocity_hot(spark, d):
    """Every user takes the way of users with very many rows."""
    tx = C.transactions(spark, d).select("event_id", "user_id", "purchase_time")
    return features.velocity(tx, windows=["1h", "24h", "7d", "30d"], max_group_rows=0)


def win3_user_gaps_hot(spark, d):
    tx = C.transactions(spark, d).select("event_id", "user_id", "purchase_time")
    return rounded(features.user_gaps(tx, max_group_rows=0))


def win2_velocity_before(spark, d):
    tx = C.transactions(spark, d).select("event_id", "user_id", "purchase_time")
    return features.velocity(tx, windows=["1h", "24h", "7d"], closed="left")


def win2_velocity_before_ties(spark, d):
    orders = C.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return features.velocity(orders, "o_custkey", "o_orderdate", ["30d"], closed="left")


def win3_user_gaps(spark, d):
    tx = C.transactions(spark, d).select("event_id", "user_id", "purchase_time")
    return rounded(features.user_gaps(tx))


def _velocity_sql(user, ts, windows, closed, prefix):
    hours = {"1h": 1, "24h": 24, "7d": 168, "30d": 720}
    end = "current row" if closed == "both" else "interval 1 microsecond preceding"
    less = " - 1" if closed == "both" else ""
    return ", ".join(
        f"count(*) over (partition by {user} order by {ts} range between interval {hours[w]} hour preceding and {end}){less}"
        f" as {prefix}{w}"
        for w in windows
    )


# --- encoding, scaling --------------------------------------------------------

CODE_COLUMNS = ("device_id", "source", "browser")


def enc1_label_mapping(spark, d):
    return encode.label_fit(C.transactions(spark, d), CODE_COLUMNS)


def enc1_label_codes(spark, d):
    tx = C.transactions(spark, d).select("event_id", "device_id", "source", "class").withColumn(
        "source", F.when(F.col("event_id") % 89 != 0, F.col("source"))
    )
    return encode.label_apply(tx, encode.label_fit(tx, ["device_id", "source"]), ["device_id", "source"])


def enc2_onehot(spark, d):
    tx = C.transactions(spark, d).select("event_id", "source", "browser")
    return encode.onehot_apply(tx, encode.onehot_fit(tx, ["source", "browser"]))


def enc3_onehot_all(spark, d):
    tx = C.transactions(spark, d).select("event_id", "source", "browser", "sex")
    return encode.onehot_apply(tx, encode.onehot_fit(tx, ["source", "browser", "sex"]), drop_first=False)


def enc4_codes_only(spark, d):
    tx = C.transactions(spark, d).select("event_id", "sex", "browser")
    return encode.label_apply(tx, encode.label_fit(tx, ["sex", "browser"]), ["sex", "browser"], drop_original=True)


def _onehot_sql(values: dict) -> str:
    cols = [f"cast({c} = '{v}' as int) as \"{c}_{v}\"" for c, vs in values.items() for v in vs]
    return with_ctes(TX, f"select event_id, {', '.join(cols)} from tx")


BROWSERS = ["Chrome", "FireFox", "IE", "Opera", "Safari"]
SOURCES = ["Ads", "Direct", "SEO"]
SCALED = ("purchase_value", "age", "constant")


def _scaling_input(spark, d):
    return C.transactions(spark, d).select("event_id", "purchase_value", "age", F.lit(7.0).alias("constant"), "class")


def sca1_standard(spark, d):
    df = _scaling_input(spark, d)
    return rounded(scale.apply(df, scale.fit(df, SCALED)))


def sca2_minmax(spark, d):
    df = _scaling_input(spark, d)
    return rounded(scale.apply(df, scale.fit(df, SCALED, "minmax")))


def sca3_fit_on_normal(spark, d):
    """Parameters of the normal transactions, applied to the whole table."""
    params = scale.fit(_scaling_input(spark, d).where("class = 0"), SCALED)
    return rounded(scale.apply(_scaling_input(spark, d), params))


def sca4_compare(spark, d):
    return rounded(scale.compare(C.transactions(spark, d), ["purchase_value", "age"]))


SCALE_BASE = TX + ", s as (select event_id, purchase_value, cast(age as double) as age, 7.0::double as constant, class from tx)"


def _scale_sql(kind: str, stats_where: str = "") -> str:
    center, spread = {
        "standard": ("avg({c})", "stddev_pop({c})"),
        "minmax": ("min({c})", "max({c}) - min({c})"),
    }[kind]
    stats = ", ".join(f"{center} as {c}_a, {spread} as {c}_b".replace("{c}", c) for c in SCALED)
    cols = ", ".join(f"round(({c} - {c}_a) / case when {c}_b = 0 then 1 else {c}_b end, 6) + 0.0 as {c}" for c in SCALED)
    return with_ctes(
        SCALE_BASE + f", p as (select {stats} from s {stats_where})", f"select event_id, {cols}, class from s, p"
    )


def _compare_sql() -> str:
    parts = []
    for c in ("purchase_value", "age"):
        versions = {
            "raw": c,
            "standard": f"({c} - (select avg({c}) from tx)) / (select stddev_pop({c}) from tx)",
            "minmax": f"({c} - (select min({c}) from tx)) / (select cast(max({c}) - min({c}) as double) from tx)",
        }
        for name, e in versions.items():
            parts.append(
                f"select '{name}' as version, '{c}' as column_name, count(v) as count, round(avg(v), 6) + 0.0 as mean,"
                " round(stddev_samp(v), 6) as std, round(min(v), 6) as min, round(quantile_cont(v, 0.25), 6) as q25,"
                " round(quantile_cont(v, 0.5), 6) as q50, round(quantile_cont(v, 0.75), 6) as q75, round(max(v), 6) as max"
                f" from (select cast({e} as double) as v from tx)"
            )
    return with_ctes(TX, union_sql(parts))


# --- splits, samples ----------------------------------------------------------


def spl1_stratified_exact(spark, d):
    return split.stratified(C.transactions(spark, d), ["event_id"]).select("event_id", "class", "split")


def spl1_stratified_threshold(spark, d):
    return split.stratified(C.transactions(spark, d), ["event_id"], exact=False).select("event_id", "class", "split")


def spl1_stratified_bank(spark, d):
    return split.stratified(C.bank(spark, d), ["l_orderkey", "l_linenumber"], "Class", 0.3, 7).select(
        "l_orderkey", "l_linenumber", "Class", "split"
    )


def spl2_distribution(spark, d):
    return split.split_distribution(split.stratified(C.transactions(spark, d), ["event_id"]), "class")


def spl3_prepare_test(spark, d):
    return split.prepare_and_split(C.transactions(spark, d), ["event_id"]).test


def smp1_sample_per_class(spark, d):
    return split.sample_per_class(C.transactions(spark, d), ["event_id"], "class", {0: 5000, 1: 500})


def smp2_sample_rows(spark, d):
    return split.sample_rows(C.transactions(spark, d), ["event_id"], 100)


H42 = hash32_sql(EVENT_KEY, 42)
SPLIT_CTE = (
    TX
    + f""", parts as (
  select *, case when row_number() over (partition by class order by {H42}, event_id)
    <= floor(count(*) over (partition by class) * 0.2 + 0.5) then 'test' else 'train' end as split from tx)"""
)
COPY_KEY = "vec_id || '|' || copy"
BANK_KEY = "l_orderkey || '|' || l_linenumber"


# --- resampling ---------------------------------------------------------------


def res1_smote(spark, d):
    """Class sizes after oversampling."""
    df = C.wide_features(spark, d)
    grown = resample.smote(df, ["vec_id"], "Class", DIM_NAMES, 0.5)
    return grown.groupBy("Class", (F.col("copy") > 0).alias("synthetic")).agg(F.count(F.lit(1)).alias("n"))


def res1_smote_transactions(spark, d):
    tx = C.transactions(spark, d).select("event_id", "purchase_value", "age", "class")
    return rounded(resample.smote(tx, ["event_id"], ratio=0.3))


def res2_undersample(spark, d):
    return resample.undersample(C.transactions(spark, d), ["event_id"], ratio=0.5)


def res3_smote_undersample(spark, d):
    df = C.wide_features(spark, d)
    return rounded(resample.smote_undersample(df, ["vec_id"], "Class", DIM_NAMES, 0.3, 0.5))


def res4_choose_strategy(spark, d):
    return rounded(resample.choose_strategy(C.transactions(spark, d)))


def res4_choose_strategy_bank(spark, d):
    return rounded(resample.choose_strategy(C.bank(spark, d), "Class"))


def res5_class_weights(spark, d):
    return rounded(resample.class_weights(C.transactions(spark, d)))


def res5_scale_pos_weight(spark, d):
    return rounded(resample.scale_pos_weight(C.transactions(spark, d)))


def pip1_scale_and_undersample(spark, d):
    steps = resample.Preprocessing("standard", "undersample")
    tx = C.transactions(spark, d)
    return rounded(steps.fit_train(tx, ["event_id"], ["purchase_value", "age"]))


def pip2_transform_test(spark, d):
    steps = resample.Preprocessing("minmax")
    tx = C.transactions(spark, d)
    parts = split.stratified(tx, ["event_id"])
    steps.fit_train(parts.where("split = 'train'"), ["event_id"], ["purchase_value", "age"])
    return rounded(steps.transform(parts.where("split = 'test'")).select("event_id", "purchase_value", "age", "class"))


def _strategy_sql(ctes: str, label: str, table: str) -> str:
    return with_ctes(
        ctes,
        "select normal_count, fraud_count, round(r, 6) as imbalance_ratio,"
        " case when r > 100 then 'smote_undersample' when r > 5 then 'smote' else 'class_weights' end as strategy,"
        " cast(case when r > 100 then 0.1 when r > 10 then 0.5 when r > 5 then 0.3 end as double) as smote_ratio,"
        " cast(case when r > 100 then 0.5 end as double) as under_ratio from"
        f' (select count(*) filter ("{label}" = 0) as normal_count, count(*) filter ("{label}" = 1) as fraud_count,'
        f' case when count(*) filter ("{label}" = 1) > 0 then count(*) filter ("{label}" = 0)'
        f' / count(*) filter ("{label}" = 1) else 0 end as r from {table})',
    )


def smote_ctes(table: str, key: str, features: list[str], label: str, ratio: float, k: int = 5, seed: int = 42) -> str:
    """CTE ``grown`` (key, features, label, copy): oversampling by brute force over all minority pairs."""
    f = ", ".join(f'cast("{c}" as double) as "{c}"' for c in features)
    text = " || ',' || ".join(f'cast("{c}" as varchar)' for c in features)
    firsts = ", ".join(f'any_value("{c}") as "{c}"' for c in features)
    square = " + ".join(f'(a."{c}" - b."{c}") * (a."{c}" - b."{c}")' for c in features)
    copy_key = f"{key} || '|' || copy"
    moved = ", ".join(f's."{c}" + s.step * (m."{c}" - s."{c}") as "{c}"' for c in features)
    return f"""source as (select {key}, {f}, "{label}" from {table}),
  few as (select *, md5({text}) as vid, row_number() over (order by {hash32_sql(f"cast({key} as varchar)", seed)}, {key}) as draw
    from source where "{label}" = 1),
  sizes as (select (select count(*) from few) as n1,
    cast(floor((select count(*) from source where "{label}" = 0) * {ratio}) as bigint) - (select count(*) from few) as wanted),
  points as (select vid, count(*) as n, {firsts} from few group by vid),
  pairs as (select a.vid, b.vid as nvid, b.n, row_number() over (partition by a.vid order by sqrt({square}), b.vid) as r
    from points a join points b on a.vid <> b.vid qualify r <= {k}),
  runs as (select vid, vid as nvid, 0 as r, least(n - 1, {k}) as size from points
    union all select vid, nvid, r, least(n, {k}) from pairs),
  spans as (select *, sum(size) over (partition by vid order by r) as stop from runs),
  places as (select vid, least(max(stop), {k}) as places from spans group by vid),
  copies as (select few.*, unnest(range(1, 2 + cast(wanted // n1 as bigint) + case when draw <= wanted % n1 then 1 else 0 end - 1)) as copy
    from few, sizes),
  steps as (select copies.*, {hash32_sql(copy_key, seed)} % places + 1 as place, {uniform_sql(copy_key, seed + 1)} as step
    from copies join places using (vid)),
  picked as (select s.*, spans.nvid from steps s join spans on s.vid = spans.vid and s.place <= spans.stop
    and s.place > spans.stop - spans.size),
  grown as (select {key}, {", ".join(f'"{c}"' for c in features)}, "{label}", 0 as copy from source
    union all select s.{key}, {moved}, s."{label}", cast(s.copy as int) from picked s join points m on s.nvid = m.vid)"""


def _rounded_names(names) -> str:
    return ", ".join(f'round("{c}", 6) as "{c}"' for c in names)


QUERIES = {
    "scl1_hours_since_signup": (scl1_hours_since_signup, with_ctes(TX, f"select event_id, {HOURS} as hours from tx")),
    "scl2_time_features": (scl2_time_features, with_ctes(TX, TIME_SQL)),
    "scl4_log1p": (
        scl4_log1p,
        with_ctes(BANK, 'select l_orderkey, l_linenumber, round(ln(1 + "Amount"), 6) as amount_log from bank'),
    ),
    "scl5_signup_bins": (
        scl5_signup_bins,
        with_ctes(
            TX,
            "select event_id, case when h > 0 and h <= 1 then '0-1h' when h > 1 and h <= 24 then '1-24h'"
            " when h > 24 and h <= 168 then '24-168h' when h > 168 then '>168h' end as time_bin from"
            " (select event_id, date_diff('microsecond', signup_time, purchase_time) / 3600000000.0 as h from tx)",
        ),
    ),
    "scl6_normalise": (
        scl6_normalise,
        with_ctes(
            TX,
            "select event_id, round(abs(purchase_value - 50), 6) as absolute,"
            " round(purchase_value / (select max(abs(purchase_value)) from tx), 6) as max_normalised,"
            " round(greatest(0.0, least(1.0, (purchase_value - 50) / 100)), 6) as clamped from tx",
        ),
    ),
    "scl7_keyword_rules": (
        scl7_keyword_rules,
        "select doc_id, case when contains(lower(text), 'email') or contains(lower(text), 'phone') then 'contact'"
        " when contains(lower(text), 'license') or contains(lower(text), 'copyright') then 'license'"
        " else 'other' end as category from documents",
    ),
    "scl8_ip_integer": (
        scl8_ip_integer,
        with_ctes(TX, "select event_id, cast(floor(ip_address) as bigint) as ip_address_int from tx"),
    ),
    "jon1_ip_range_join": (jon1_ip_range_join, with_ctes(GEO, "select * from geo")),
    "jon1_coverage": (
        jon1_coverage,
        with_ctes(
            GEO,
            "select count(distinct country) as countries, count(*) filter (country = 'Unknown') as unknown_rows,"
            " count(*) as total_rows from geo",
        ),
    ),
    "jon2_ip_asof_join": (
        jon2_ip_asof_join,
        with_ctes(
            TX + ", " + RANGES,
            "select event_id, ip as ip_address_int, case when ip <= r.hi then r.country else 'Unknown' end as country from"
            " (select event_id, cast(floor(ip_address) as bigint) as ip from tx) t asof left join ranges r on t.ip >= r.lo",
        ),
    ),
    "jon3_ip_exact_join": (
        jon3_ip_exact_join,
        with_ctes(
            TX + ", " + RANGES,
            "select event_id, ip as ip_address_int, coalesce(r.country, 'Unknown') as country from"
            " (select event_id, cast(floor(ip_address) as bigint) as ip from tx) t left join ranges r on t.ip = r.lo",
        ),
    ),
    "win1_velocity_ties": (
        win1_velocity_ties,
        "select o_orderkey, o_custkey, o_orderdate, "
        + _velocity_sql("o_custkey", "o_orderdate", ["24h", "30d"], "both", "transaction_count_")
        + " from orders",
    ),
    "win1_velocity": (
        win1_velocity,
        with_ctes(
            TX,
            "select event_id, user_id, purchase_time, "
            + _velocity_sql("user_id", "purchase_time", ["1h", "24h", "7d", "30d"], "both", "transaction_count_")
            + " from tx",
        ),
    ),
    "win1_velocity_hot": (
        win1_velocity_hot,
        with_ctes(
            TX,
            "select event_id, user_id, purchase_time, "
            + _velocity_sql("user_id", "purchase_time", ["1h", "24h", "7d", "30d"], "both", "transaction_count_")
            + " from tx",
        ),
    ),
    "win2_velocity_before": (
        win2_velocity_before,
        with_ctes(
            TX,
            "select event_id, user_id, purchase_time, "
            + _velocity_sql("user_id", "purchase_time", ["1h", "24h", "7d"], "left", "transactions_last_")
            + " from tx",
        ),
    ),
    "win2_velocity_before_ties": (
        win2_velocity_before_ties,
        "select o_orderkey, o_custkey, o_orderdate, "
        + _velocity_sql("o_custkey", "o_orderdate", ["30d"], "left", "transactions_last_")
        + " from orders",
    ),
    "win3_user_gaps": (
        win3_user_gaps,
        with_ctes(
            TX
            + """, g as (select event_id, user_id, purchase_time, coalesce(date_diff('microsecond',
  lag(purchase_time) over (partition by user_id order by purchase_time, event_id), purchase_time) / 3600000000.0, 0.0) as gap
  from tx)""",
            "select event_id, user_id, purchase_time, count(*) over (partition by user_id) as total_transactions_per_user,"
            " round(gap, 6) as time_since_last_transaction,"
            " round(avg(gap) over (partition by user_id), 6) as avg_time_between_transactions from g",
        ),
    ),
    "win3_user_gaps_hot": (
        win3_user_gaps_hot,
        with_ctes(
            TX
            + """, g as (select event_id, user_id, purchase_time, coalesce(date_diff('microsecond',
  lag(purchase_time) over (partition by user_id order by purchase_time, event_id), purchase_time) / 3600000000.0, 0.0) as gap
  from tx)""",
            "select event_id, user_id, purchase_time, count(*) over (partition by user_id) as total_transactions_per_user,"
            " round(gap, 6) as time_since_last_transaction,"
            " round(avg(gap) over (partition by user_id), 6) as avg_time_between_transactions from g",
        ),
    ),
    "enc1_label_mapping": (
        enc1_label_mapping,
        with_ctes(
            TX,
            union_sql(
                [
                    f"select '{c}' as column_name, v as value, row_number() over (order by v) - 1 as code"
                    f" from (select distinct {c} as v from tx)"
                    for c in CODE_COLUMNS
                ]
            ),
        ),
    ),
    "enc1_label_codes": (
        enc1_label_codes,
        with_ctes(
            TX + ", n as (select event_id, device_id, case when event_id % 89 <> 0 then source end as source, class from tx)",
            "select n.*, dense_rank() over (order by device_id) - 1 as device_id_idx,"
            " dense_rank() over (order by coalesce(source, 'nan')) - 1 as source_idx from n",
        ),
    ),
    "enc2_onehot": (enc2_onehot, _onehot_sql({"source": SOURCES[1:], "browser": BROWSERS[1:]})),
    "enc3_onehot_all": (enc3_onehot_all, _onehot_sql({"source": SOURCES, "browser": BROWSERS, "sex": ["F", "M"]})),
    "enc4_codes_only": (
        enc4_codes_only,
        with_ctes(
            TX,
            "select event_id, dense_rank() over (order by sex) - 1 as sex_idx,"
            " dense_rank() over (order by browser) - 1 as browser_idx from tx",
        ),
    ),
    "sca1_standard": (sca1_standard, _scale_sql("standard")),
    "sca2_minmax": (sca2_minmax, _scale_sql("minmax")),
    "sca3_fit_on_normal": (sca3_fit_on_normal, _scale_sql("standard", "where class = 0")),
    "sca4_compare": (sca4_compare, _compare_sql()),
    "spl1_stratified_exact": (spl1_stratified_exact, with_ctes(SPLIT_CTE, "select event_id, class, split from parts")),
    "spl1_stratified_threshold": (
        spl1_stratified_threshold,
        with_ctes(
            TX,
            f"select event_id, class, case when {uniform_sql(EVENT_KEY, 42)} < 0.2 then 'test' else 'train' end as split from tx",
        ),
    ),
    "spl1_stratified_bank": (
        spl1_stratified_bank,
        with_ctes(
            BANK,
            'select l_orderkey, l_linenumber, "Class", case when row_number() over (partition by "Class" order by '
            + hash32_sql(BANK_KEY, 7)
            + ', l_orderkey, l_linenumber) <= floor(count(*) over (partition by "Class") * 0.3 + 0.5)'
            " then 'test' else 'train' end as split from bank",
        ),
    ),
    "spl2_distribution": (
        spl2_distribution,
        with_ctes(SPLIT_CTE, "select split, class, count(*) as n from parts group by all").replace(
            "group by all", "group by split, class"
        ),
    ),
    "spl3_prepare_test": (
        spl3_prepare_test,
        with_ctes(
            SPLIT_CTE,
            "select event_id, purchase_value, device_id, source, browser, sex, age, class from parts where split = 'test'",
        ),
    ),
    "smp1_sample_per_class": (
        smp1_sample_per_class,
        with_ctes(
            TX,
            f"select * from tx qualify row_number() over (partition by class order by {H42}, event_id)"
            " <= case class when 0 then 5000 else 500 end",
        ),
    ),
    "smp2_sample_rows": (smp2_sample_rows, with_ctes(TX, f"select * from tx order by {H42}, event_id limit 100")),
    "res1_smote": (
        res1_smote,
        with_ctes(
            wide_cte(DIMS),
            'select "Class", false as synthetic, count(*) as n from wide group by 1'
            ' union all select 1, true, cast(floor(count(*) filter ("Class" = 0) * 0.5) as bigint)'
            ' - count(*) filter ("Class" = 1) from wide',
        ),
    ),
    "res1_smote_transactions": (
        res1_smote_transactions,
        with_ctes(
            TX + ", " + smote_ctes("tx", "event_id", ["purchase_value", "age"], "class", 0.3),
            f"select event_id, {_rounded_names(['purchase_value', 'age'])}, class, copy from grown",
        ),
    ),
    "res2_undersample": (
        res2_undersample,
        with_ctes(
            TX,
            f"select * from tx qualify class = 1 or row_number() over (partition by class order by {H42}, event_id)"
            " <= (select floor(count(*) / 0.5) from tx where class = 1)",
        ),
    ),
    "res3_smote_undersample": (
        res3_smote_undersample,
        with_ctes(
            wide_cte(DIMS) + ", " + smote_ctes("wide", "vec_id", DIM_NAMES, "Class", 0.3),
            f'select vec_id, {_rounded_names(DIM_NAMES)}, "Class", copy from grown qualify "Class" = 1 or row_number() over'
            f" (partition by \"Class\" order by {hash32_sql(COPY_KEY, 42)}, vec_id, copy)"
            ' <= (select floor(count(*) / 0.5) from grown where "Class" = 1)',
        ),
    ),
    "res4_choose_strategy": (res4_choose_strategy, _strategy_sql(TX, "class", "tx")),
    "res4_choose_strategy_bank": (res4_choose_strategy_bank, _strategy_sql(BANK, "Class", "bank")),
    "res5_class_weights": (
        res5_class_weights,
        with_ctes(
            TX,
            "select class, count(*) as n, round((select count(*) from tx) / ((select count(distinct class) from tx)"
            " * count(*)), 6) as weight from tx group by class",
        ),
    ),
    "res5_scale_pos_weight": (
        res5_scale_pos_weight,
        with_ctes(
            TX,
            "select round(case when count(distinct class) = 2 then count(*) filter (class = 0) / count(*) filter (class = 1)"
            " else 1.0 end, 6) as scale_pos_weight from tx",
        ),
    ),
    "pip1_scale_and_undersample": (
        pip1_scale_and_undersample,
        with_ctes(
            TX,
            "select event_id, round((purchase_value - (select avg(purchase_value) from tx))"
            " / (select stddev_pop(purchase_value) from tx), 6) as purchase_value,"
            " round((age - (select avg(age) from tx)) / (select stddev_pop(age) from tx), 6) as age, class from"
            f" (select * from tx qualify class = 1 or row_number() over (partition by class order by {H42}, event_id)"
            " <= (select count(*) from tx where class = 1))",
        ),
    ),
    "pip2_transform_test": (
        pip2_transform_test,
        with_ctes(
            SPLIT_CTE
            + """, p as (select min(purchase_value) as v0, max(purchase_value) - min(purchase_value) as v1,
  min(age) as a0, cast(max(age) - min(age) as double) as a1 from parts where split = 'train')""",
            "select event_id, round((purchase_value - v0) / v1, 6) as purchase_value, round((age - a0) / a1, 6) as age, class"
            " from parts, p where split = 'test'",
        ),
    ),
}
