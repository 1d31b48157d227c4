"""Queries on attributions, importance comparison, case studies and risk rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskframe.functions.scalar import hours_between
from riskframe.operators import attribution, explain, models
from riskframe.queries.base import PRED, TX, rounded, union_sql, with_ctes
from riskframe.queries.modelling import TX_FEATURES, model_table
from riskframe.sources import canonical as C

# Names for the first embedding components, so that every keyword rule has a feature.
NAMES = (
    "time_since_signup", "amount", "device_score", "ip_country", "transaction_count_24h", "session_length",
    "hour_of_day", "purchase_value",
    *[f"component_{j}" for j in range(8, C.DIMS)],
)
WEIGHTS = {name: (-1) ** j * (j + 1) / 8 for j, name in enumerate(NAMES)}
BUILTIN = {name: 1 / (1 + (5 * j + 3) % 8) for j, name in enumerate(NAMES)}
TX_WEIGHTS = {"purchase_value": 0.02, "age": -0.01, "hours": 0.005}


def _named(spark, d):
    wide = C.wide_features(spark, d)
    return wide.select("vec_id", *[F.col(f"f{j}").alias(name) for j, name in enumerate(NAMES)], "Class")


def _phi(spark, d):
    return attribution.linear_phi(_named(spark, d), ["vec_id"], WEIGHTS)


def _builtin(spark):
    return spark.createDataFrame(list(BUILTIN.items()), "feature string, importance double")


def _comparison(spark, d):
    return explain.compare(_builtin(spark), explain.global_importance(_phi(spark, d)))


def _tx_phi(spark, d):
    tx = C.transactions(spark, d).select(
        "event_id", "purchase_value", "age", hours_between("signup_time", "purchase_time").alias("hours")
    )
    return attribution.linear_phi(tx, ["event_id"], TX_WEIGHTS)


def exp1_importance(spark, d):
    model = models.train(model_table(spark, d), "random_forest", TX_FEATURES)
    return explain.importance(model, TX_FEATURES)


def exp1_coefficients(spark, d):
    model = models.train(model_table(spark, d), "logistic_regression", TX_FEATURES)
    return explain.importance(model, TX_FEATURES)


def exp2_linear_phi(spark, d):
    return rounded(_phi(spark, d))


def exp2_linear_phi_transactions(spark, d):
    return rounded(_tx_phi(spark, d))


def exp3_tree_phi(spark, d):
    data = model_table(spark, d)
    model = models.train(data, "random_forest", TX_FEATURES)
    return attribution.tree_phi(model, data, ["event_id"], TX_FEATURES)


def exp3_tree_phi_adds_up(spark, d):
    """Rows explained, and rows whose base value plus attributions differ from the score."""
    data = model_table(spark, d)
    model = models.train(data, "random_forest", TX_FEATURES)
    phi = attribution.tree_phi(model, data, ["event_id"], TX_FEATURES)
    total = phi.groupBy("event_id").agg((F.sum("phi") + F.max("base_value")).alias("total"))
    both = models.predict(model, data).join(total, "event_id")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(F.col("score") - F.col("total")) > 1e-9).alias("n_off")
    )


def exp3_one_split_phi(spark, d):
    """Attributions of one boosted tree with one split, whose margin is +1 or -1 by the rule."""
    data = model_table(spark, d)
    model = models.train(data, "gradient_boosting", TX_FEATURES, class_weight=None, n_estimators=1, max_depth=1)
    return rounded(attribution.tree_phi(model, data, ["event_id"], TX_FEATURES))


def exp4_sampled_phi(spark, d):
    """Sampled attributions of every embedding row."""
    names = list(NAMES)
    data = _named(spark, d)
    model = models.train(data, "logistic_regression", names, "Class")
    return attribution.sampled_phi(model, data, ["vec_id"], names, data)


def exp4_sampled_phi_adds_up(spark, d):
    """Rows explained, and rows whose base value plus attributions differ from the score."""
    names = list(NAMES)
    data = _named(spark, d)
    model = models.train(data, "logistic_regression", names, "Class")
    phi = attribution.sampled_phi(model, data, ["vec_id"], names, data)
    total = phi.groupBy("vec_id").agg((F.sum("phi") + F.max("base_value")).alias("total"))
    both = models.predict(model, data).join(total, "vec_id")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(F.col("score") - F.col("total")) > 1e-9).alias("n_off")
    )


def exp5_global_importance(spark, d):
    return rounded(explain.global_importance(_phi(spark, d)))


def exp6_compare(spark, d):
    return rounded(_comparison(spark, d))


def exp7_top_drivers(spark, d):
    return rounded(explain.top_drivers(_comparison(spark, d), 5))


def exp7_top_drivers_shap(spark, d):
    return rounded(explain.top_drivers(_comparison(spark, d), 3, "shap"))


def exp8_surprising(spark, d):
    return rounded(explain.surprising(_comparison(spark, d)))


def exp9_case_studies(spark, d):
    return rounded(explain.case_studies(C.predictions(spark, d), "event_id", 3))


def exp10_case_contributions(spark, d):
    cases = explain.case_studies(C.predictions(spark, d), "event_id", 3)
    return rounded(explain.case_contributions(cases, _tx_phi(spark, d), "event_id"))


def exp11_attribution_summary(spark, d):
    return rounded(explain.attribution_summary(_tx_phi(spark, d), 2))


def exp12_risk_rules(spark, d):
    comparison = _comparison(spark, d)
    return explain.risk_rules(explain.top_drivers(comparison, 5), explain.surprising(comparison))


def exp12_priority_counts(spark, d):
    comparison = _comparison(spark, d)
    return explain.priority_counts(explain.risk_rules(explain.top_drivers(comparison, 5), explain.surprising(comparison)))


def exp13_interpretation(spark, d):
    data = model_table(spark, d)
    model = models.train(data, "random_forest", TX_FEATURES)
    phi = attribution.tree_phi(model, data, ["event_id"], TX_FEATURES)
    return explain.interpretation(explain.importance(model, TX_FEATURES), phi).rules


# --- SQL ----------------------------------------------------------------------


def _phi_cte() -> str:
    parts = []
    for j, name in enumerate(NAMES):
        x = f"cast(embedding[{j + 1}] as double)"
        parts.append(
            f"select vec_id, '{name}' as feature, {x} as value, {WEIGHTS[name]} * ({x} - (select avg({x}) from embeddings))"
            " as phi from embeddings"
        )
    base = " + ".join(f"{w} * avg(cast(embedding[{j + 1}] as double))" for j, w in enumerate(WEIGHTS.values()))
    return f"raw as ({union_sql(parts)}), phi as (select *, (select {base} from embeddings) as base_value from raw)"


def _tx_phi_cte() -> str:
    cols = {"purchase_value": "purchase_value", "age": "cast(age as double)",
            "hours": "date_diff('microsecond', signup_time, purchase_time) / 3600000000.0"}
    parts = [
        f"select event_id, '{c}' as feature, {e} as value, {TX_WEIGHTS[c]} * ({e} - (select avg({e}) from tx)) as phi from tx"
        for c, e in cols.items()
    ]
    base = " + ".join(f"{TX_WEIGHTS[c]} * avg({e})" for c, e in cols.items())
    return f"raw as ({union_sql(parts)}), phi as (select *, (select {base} from tx) as base_value from raw)"


PHI = _phi_cte()
TX_PHI = _tx_phi_cte()
ROUND_PHI = "round(value, 6) as value, round(phi, 6) as phi, round(base_value, 6) as base_value"
COMPARE = (
    PHI
    + ", builtin as ("
    + union_sql([f"select '{n}' as feature, cast({v!r} as double) as importance" for n, v in BUILTIN.items()])
    + """), shap as (select feature, avg(abs(phi)) as importance from phi group by feature),
  ranked as (select feature, b.importance as builtin_importance, s.importance as shap_importance,
    row_number() over (order by b.importance desc, feature) as builtin_rank,
    row_number() over (order by s.importance desc, feature) as shap_rank from builtin b join shap s using (feature)),
  compared as (select *, builtin_rank - shap_rank as rank_difference,
    builtin_importance / max(builtin_importance) over () as builtin_importance_norm,
    shap_importance / max(shap_importance) over () as shap_importance_norm,
    builtin_importance / max(builtin_importance) over () - shap_importance / max(shap_importance) over () as importance_difference,
    (builtin_rank + shap_rank) / 2 as avg_rank from ranked)"""
)


ONE_SPLIT = with_ctes(
    TX
    + """, m as (select event_id, purchase_value, cast(age as double) as age,
    date_diff('microsecond', signup_time, purchase_time) / 3600000000.0 as hours,
    case source when 'Ads' then 0.0 when 'Direct' then 1.0 else 2.0 end as source_code,
    case when source = 'SEO' then 1.0 else -1.0 end as margin from tx), b as (select avg(margin) as base from m)""",
    union_sql(
        [
            f"select event_id, '{c}' as feature, round(cast({c} as double), 6) as value,"
            f" round(cast({'margin - base' if c == 'source_code' else '0'} as double), 6) as phi, round(base, 6) as base_value from m, b"
            for c in TX_FEATURES
        ]
    ),
)


def _drivers_sql(by: str, n: int) -> str:
    return (
        f"select row_number() over (order by {by}, avg_rank, feature) as place, * from compared"
        f" order by {by}, avg_rank, feature limit {n}"
    )


def _top_drivers_sql(by: str, n: int) -> str:
    return with_ctes(
        COMPARE,
        "select cast(place as int) as place, feature, round(builtin_importance, 6) as builtin_importance,"
        " round(shap_importance, 6) as shap_importance, cast(builtin_rank as int) as builtin_rank,"
        f" cast(shap_rank as int) as shap_rank, cast(rank_difference as int) as rank_difference from ({_drivers_sql(by, n)})",
    )


FOUND = (
    "found as (select 'high_rank_difference' as finding, feature, builtin_rank, shap_rank, avg_rank,"
    " cast(abs(rank_difference) as double) as magnitude from compared where abs(rank_difference) >= 5"
    " union all select 'importance_mismatch', feature, builtin_rank, shap_rank, avg_rank, abs(importance_difference) from compared"
    " where abs(importance_difference) >= 0.2"
    " union all select 'shap_higher', feature, builtin_rank, shap_rank, avg_rank, abs(rank_difference) from compared"
    " where shap_rank < builtin_rank and abs(rank_difference) >= 3"
    " union all select 'builtin_higher', feature, builtin_rank, shap_rank, avg_rank, abs(rank_difference) from compared"
    " where builtin_rank < shap_rank and abs(rank_difference) >= 3)"
)


def _words(words) -> str:
    return "(" + " or ".join(f"contains(feature, '{w}')" for w in words) + ")"


def _rules_cte() -> str:
    time = f"when {_words(explain.TIME_WORDS)} then"
    category = f"{time} case when {_words(explain.SIGNUP_WORDS)} then 'signup_time' when {_words(explain.TIMING_WORDS)} then 'purchase_time' end"
    priority = f"{time} case when {_words(explain.SIGNUP_WORDS)} or {_words(explain.TIMING_WORDS)} then 'HIGH' end"
    for name, level, words in explain.OTHER_RULES:
        category += f" when {_words(words)} then '{name}'"
        priority += f" when {_words(words)} then '{level}'"
    general = union_sql(
        [f"select {i} as i, '{f}' as feature, '{c}' as category, '{p}' as priority" for i, (f, c, p) in enumerate(explain.GENERAL_RULES)]
    )
    return (
        f"drivers as ({_drivers_sql('avg_rank', 5)}), matched as (select feature, case {category} end as category,"
        f" case {priority} end as priority from drivers), some_rules as (select * from matched where category is not null"
        " union all select * from (select feature, 'investigate', 'MEDIUM' from found where finding = 'shap_higher'"
        f" order by avg_rank, feature limit 2)), general as ({general}), rules as (select * from some_rules union all"
        " select feature, category, priority from general where i < 3 - (select count(*) from some_rules))"
    )


CASES = (
    "typed as (select event_id, case when prediction = 1 and class = 1 then 'TP' when prediction = 1 and class = 0 then 'FP'"
    " when prediction = 0 and class = 1 then 'FN' end as case_type, prediction, class as actual, score as probability from pred),"
    " cases as (select *, cast(row_number() over (partition by case_type order by event_id) as int) as place from typed"
    " where case_type is not null qualify place <= 3 and count(*) over (partition by case_type) >= 3)"
)

QUERIES = {
    "exp1_importance": (exp1_importance, None),
    "exp1_coefficients": (exp1_coefficients, None),
    "exp2_linear_phi": (exp2_linear_phi, with_ctes(PHI, f"select vec_id, feature, {ROUND_PHI} from phi")),
    "exp2_linear_phi_transactions": (
        exp2_linear_phi_transactions,
        with_ctes(TX + ", " + TX_PHI, f"select event_id, feature, {ROUND_PHI} from phi"),
    ),
    "exp3_tree_phi": (exp3_tree_phi, None),
    "exp3_one_split_phi": (exp3_one_split_phi, ONE_SPLIT),
    "exp3_tree_phi_adds_up": (
        exp3_tree_phi_adds_up,
        "select count(*) as n_rows, cast(0 as bigint) as n_off from events",
    ),
    "exp4_sampled_phi": (exp4_sampled_phi, None),
    "exp4_sampled_phi_adds_up": (
        exp4_sampled_phi_adds_up,
        "select count(*) as n_rows, cast(0 as bigint) as n_off from embeddings",
    ),
    "exp5_global_importance": (
        exp5_global_importance,
        with_ctes(PHI, "select feature, round(avg(abs(phi)), 6) as shap_importance from phi group by feature"),
    ),
    "exp6_compare": (
        exp6_compare,
        with_ctes(
            COMPARE,
            "select feature, round(builtin_importance, 6) as builtin_importance, cast(builtin_rank as int) as builtin_rank,"
            " round(shap_importance, 6) as shap_importance, cast(shap_rank as int) as shap_rank,"
            " cast(rank_difference as int) as rank_difference, round(builtin_importance_norm, 6) as builtin_importance_norm,"
            " round(shap_importance_norm, 6) as shap_importance_norm, round(importance_difference, 6) as importance_difference,"
            " avg_rank from compared",
        ),
    ),
    "exp7_top_drivers": (exp7_top_drivers, _top_drivers_sql("avg_rank", 5)),
    "exp7_top_drivers_shap": (exp7_top_drivers_shap, _top_drivers_sql("shap_rank", 3)),
    "exp8_surprising": (
        exp8_surprising,
        with_ctes(
            COMPARE + ", " + FOUND,
            "select finding, feature, cast(builtin_rank as int) as builtin_rank, cast(shap_rank as int) as shap_rank, avg_rank,"
            " round(magnitude, 6) as magnitude from found",
        ),
    ),
    "exp9_case_studies": (
        exp9_case_studies,
        with_ctes(PRED + ", " + CASES, "select event_id, case_type, prediction, actual, probability, place from cases"),
    ),
    "exp10_case_contributions": (
        exp10_case_contributions,
        with_ctes(
            PRED + ", " + CASES + ", " + TX_PHI,
            "select event_id, case_type, probability, cast(row_number() over (partition by event_id order by abs(phi) desc,"
            f" feature) as int) as place, feature, {ROUND_PHI} from phi join (select event_id, case_type, probability from cases)"
            " using (event_id)",
        ),
    ),
    "exp11_attribution_summary": (
        exp11_attribution_summary,
        with_ctes(
            TX + ", " + TX_PHI
            + ", top as (select feature, avg(abs(phi)) as i, cast(row_number() over (order by avg(abs(phi)) desc, feature) as int)"
            " as place from phi group by feature qualify place <= 2)",
            f"select feature, event_id, {ROUND_PHI}, round(i, 6) as shap_importance, place from phi join top using (feature)",
        ),
    ),
    "exp12_risk_rules": (
        exp12_risk_rules,
        with_ctes(", ".join([COMPARE, FOUND, _rules_cte()]), "select feature, category, priority from rules"),
    ),
    "exp12_priority_counts": (
        exp12_priority_counts,
        with_ctes(", ".join([COMPARE, FOUND, _rules_cte()]), "select priority, count(*) as n from rules group by priority"),
    ),
    "exp13_interpretation": (exp13_interpretation, None),
}
