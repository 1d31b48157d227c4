"""Queries on metrics, training, cross-validation and ranking."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.functions.scalar import hours_between, uniform
from riskframe.operators import metrics as M
from riskframe.operators import models, selection, split
from riskframe.operators.lineage import cut, work_dir
from riskframe.plans import comparison, etl
from riskframe.queries.base import EVENT_KEY, PRED, TX, hash32_sql, rounded, uniform_sql, union_sql, with_ctes
from riskframe.sources import canonical as C

# Scored "models" that need no training: name, type, interpretability, seed, lift of fraud rows.
SCORERS = (
    ("Model A", "baseline", 1.0, 42, 30),
    ("Model B", "random_forest", 0.6, 43, 37),
    ("Model C", "xgboost", 0.5, 44, 34),
)
MODEL_IDS = ["model_name", "model_type", "interpretability_score"]
PROFILES = {"performance": (0.7, 0.3), "balanced": (0.5, 0.5), "interpretability": (0.3, 0.7)}
TX_FEATURES = ["purchase_value", "age", "hours", "source_code"]


def scored_models(spark, d) -> DataFrame:
    """Predictions of all scorers on every transaction, with folds; one pass over the table."""
    tx = split.folds(C.transactions(spark, d).select("event_id", "class"), ["event_id"], "class")
    rows = []
    for name, kind, interpretability, seed, lift in SCORERS:
        score = (F.floor(60 * uniform(["event_id"], seed)) + lift * F.col("class")) / F.lit(100.0)
        rows.append(
            F.struct(
                F.lit(name).alias("model_name"),
                F.lit(kind).alias("model_type"),
                F.lit(interpretability).alias("interpretability_score"),
                score.alias("score"),
            )
        )
    return tx.select("event_id", "fold", "class", F.inline(F.array(*rows))).withColumn(
        "prediction", (F.col("score") >= 0.5).cast("int")
    )


FOLDED = (
    TX
    + f""", folded as (
  select event_id, class, cast((row_number() over (partition by class order by {hash32_sql(EVENT_KEY, 42)}, event_id) - 1) % 5
    as int) as fold from tx)"""
)

SCORED = (
    FOLDED
    + ", scored as (select *, cast(score >= 0.5 as int) as prediction from ("
    + union_sql(
        [
            f"select '{name}' as model_name, '{kind}' as model_type, cast({i} as double) as interpretability_score, event_id,"
            f" fold, class, (floor(60 * {uniform_sql(EVENT_KEY, seed)}) + {lift} * class) / 100.0 as score from folded"
            for name, kind, i, seed, lift in SCORERS
        ]
    )
    + "))"
)


def metric_ctes(table: str, by: list[str], prefix: str = "") -> str:
    """CTE ``<prefix>metrics``: (by, accuracy, ..., pr_auc) of a prediction table."""
    b = ", ".join(by) + ", " if by else ""
    g = f"group by {', '.join(by)}" if by else ""
    part = f"partition by {', '.join(by)}" if by else ""
    join = f"join {prefix}areas using ({', '.join(by)})" if by else f", {prefix}areas"
    return f"""{prefix}cells as (select {b}count(*) filter (class = 0 and prediction = 0) as tn,
    count(*) filter (class = 0 and prediction = 1) as fp, count(*) filter (class = 1 and prediction = 0) as fn,
    count(*) filter (class = 1 and prediction = 1) as tp from {table} {g}),
  {prefix}counts as (select {b}score, cast(count(*) as double) as n, cast(sum(class) as double) as pos
    from {table} group by {b}score),
  {prefix}running as (select *, sum(n) over ({part} order by score desc) as cn, sum(pos) over ({part} order by score desc) as cp
    from {prefix}counts),
  {prefix}areas as (select {b}case when sum(pos) > 0 and sum(n - pos) > 0 then
    1 - sum(pos * ((cn - n) - (cp - pos) + (n - pos) / 2)) / (sum(pos) * sum(n - pos)) end as roc_auc,
    case when sum(pos) > 0 then sum(pos * cp / cn) / sum(pos) end as pr_auc from {prefix}running {g}),
  {prefix}metrics as (select {b}(tp + tn) / (tp + tn + fp + fn) as accuracy,
    case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as precision,
    case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as recall,
    case when 2 * tp + fp + fn > 0 then 2 * tp / (2 * tp + fp + fn) else 0.0 end as f1, roc_auc, pr_auc
    from {prefix}cells {join})"""


def long_metrics(by: list[str], prefix: str = "") -> str:
    b = ", ".join(by) + ", " if by else ""
    return union_sql([f"select {b}'{m}' as metric, {m} as value from {prefix}metrics" for m in M.METRICS])


def met1_scores(spark, d):
    return rounded(M.scores(C.predictions(spark, d)))


def met2_roc_auc(spark, d):
    return rounded(M.roc_auc(C.predictions(spark, d)))


def met2_roc_auc_one_class(spark, d):
    return rounded(M.ranking_scores(C.predictions(spark, d).where("class = 0")))


def met3_average_precision(spark, d):
    return rounded(M.average_precision(C.predictions(spark, d)))


def met4_confusion(spark, d):
    return M.confusion(C.predictions(spark, d))


def met5_report(spark, d):
    return rounded(M.report(C.predictions(spark, d)))


def met1_evaluate_all(spark, d):
    return rounded(M.evaluate(C.predictions(spark, d)))


def mod7_folds(spark, d):
    return split.folds(C.transactions(spark, d).select("event_id", "class"), ["event_id"], "class")


def mod7_fold_metrics(spark, d):
    return rounded(M.evaluate(scored_models(spark, d), by=["model_name", "fold"]))


def mod7_fold_summary(spark, d):
    folds = M.evaluate(scored_models(spark, d), by=["model_name", "fold"])
    return rounded(selection.summarise_folds(folds, ["model_name"]))


def _board(spark, d):
    scored = cut(scored_models(spark, d))
    test = cut(M.evaluate(scored, by=MODEL_IDS))
    cv = cut(selection.summarise_folds(M.evaluate(scored, by=["model_name", "fold"]), ["model_name"]))
    return test, cv


def mod9_leaderboard(spark, d):
    test, cv = _board(spark, d)
    return rounded(selection.leaderboard(test, cv))


def mod9_leaderboard_test_only(spark, d):
    test, _ = _board(spark, d)
    return rounded(selection.leaderboard(test, None, "pr_auc", 0.5, 0.5))


def mod9_summary(spark, d):
    test, cv = _board(spark, d)
    return rounded(selection.board_summary(selection.leaderboard(test, cv)))


def snk3_json_summary(spark, d):
    """The ranking written as JSON and read back."""
    test, cv = _board(spark, d)
    path = f"{work_dir(spark)}/{etl.run_name()}"
    result = comparison.Comparison(selection.leaderboard(test, cv), test, cv, {}, [])
    comparison.save_json_summary(result, path, "ecommerce")
    back = spark.read.schema("dataset string, model_name string, overall_score double, place int").json(f"{path}/leaderboard")
    return rounded(back)


def mod9b_profiles(spark, d):
    test, cv = _board(spark, d)
    return rounded(selection.leaderboard_profiles(test, PROFILES, cv))


def mod10_margins(spark, d):
    test, cv = _board(spark, d)
    return rounded(selection.margins(selection.leaderboard(test, cv)))


FOLD_SUMMARY = (
    f"fm as ({long_metrics(['model_name', 'fold'], 'f_')}),"
    " fs as (select model_name, metric, avg(value) as mean, stddev_pop(value) as std, min(value) as min, max(value) as max"
    " from fm group by model_name, metric)"
)
BOARD_CTES = ", ".join([SCORED, metric_ctes("scored", MODEL_IDS, "t_"), metric_ctes("scored", ["model_name", "fold"], "f_"), FOLD_SUMMARY])


def board_sql(metric: str, with_cv: bool, interpretability: float, performance: float) -> str:
    """CTEs ending in ``board``."""
    score = f"t.{metric}"
    if with_cv:
        score = f"(select mean - std from fs where fs.model_name = t.model_name and metric = '{metric}')"
    return f"""p as (select t.*, greatest(0.0, least(1.0, {score})) as performance_score from t_metrics t),
  q as (select *, case when max(performance_score) over () = min(performance_score) over () then 1.0 else
    (performance_score - min(performance_score) over ()) / (max(performance_score) over () - min(performance_score) over ())
    end as normalised_performance from p),
  o as (select *, {performance} * normalised_performance + {interpretability} * interpretability_score as overall_score from q),
  board as (select *, row_number() over (order by overall_score desc, model_name) as place from o)"""


def _leaderboard_sql(metric="f1", with_cv=True, interpretability=0.3, performance=0.7, ctes=BOARD_CTES) -> str:
    cols = ", ".join(f"round({m}, 6) as test_{m}" for m in M.METRICS)
    cv = ""
    if with_cv:
        cv = ", " + ", ".join(
            f"(select round({s}, 6) from fs where fs.model_name = board.model_name and metric = '{m}') as cv_{m}_{s}"
            for m in M.METRICS
            for s in ("mean", "std")
        )
    return with_ctes(
        ctes + ", " + board_sql(metric, with_cv, interpretability, performance),
        f"select model_name, model_type, interpretability_score, {cols}{cv}, round(performance_score, 6) as performance_score,"
        " round(normalised_performance, 6) as normalised_performance, round(overall_score, 6) as overall_score,"
        " cast(place as int) as place from board",
    )


def _profiles_sql() -> str:
    parts = [
        f"select '{name}' as profile, model_name, {performance} * normalised_performance + {interpretability}"
        " * interpretability_score as s from q"
        for name, (performance, interpretability) in PROFILES.items()
    ]
    return with_ctes(
        BOARD_CTES + ", " + board_sql("f1", True, 0.3, 0.7) + f", u as ({union_sql(parts)})",
        "select profile, model_name, round(s, 6) as overall_score,"
        " cast(row_number() over (partition by profile order by s desc, model_name) as int) as place from u",
    )


# --- training -----------------------------------------------------------------


def ruled(spark, d) -> DataFrame:
    """Transactions whose label one column decides (1 for source SEO), so that what a model has to learn is known."""
    return C.transactions(spark, d).withColumn("class", (F.col("source") == "SEO").cast("int"))


def model_table(spark, d) -> DataFrame:
    """``ruled`` transactions with numeric features; the code of the source stands for the source."""
    return ruled(spark, d).select(
        "event_id",
        "purchase_value",
        F.col("age").cast("double").alias("age"),
        hours_between("signup_time", "purchase_time").alias("hours"),
        F.expr("case source when 'Ads' then 0.0D when 'Direct' then 1.0D else 2.0D end").alias("source_code"),
        "class",
    )


def shared_rule_table(spark, d) -> DataFrame:
    """``ruled`` transactions with two features that both decide the label: the source, and the user's share of it."""
    share = F.avg(F.col("class").cast("double")).over(Window.partitionBy("user_id"))
    return ruled(spark, d).select(
        "event_id", F.expr("case source when 'Ads' then 0.0D when 'Direct' then 1.0D else 2.0D end").alias("source_code"),
        share.alias("seo_share"), "class",
    )


def _fit_and_score(spark, d, kind, **params):
    data = selection.spread(split.stratified(model_table(spark, d), ["event_id"]), ["event_id"])
    train, test = data.where("split = 'train'").drop("split"), data.where("split = 'test'").drop("split")
    return models.train_and_evaluate(train, test, kind, TX_FEATURES, **params)


def mod1_logistic_regression(spark, d):
    return rounded(_fit_and_score(spark, d, "logistic_regression").metrics)


def mod2_random_forest(spark, d):
    return rounded(_fit_and_score(spark, d, "random_forest").metrics)


def mod3_gradient_boosting(spark, d):
    return rounded(_fit_and_score(spark, d, "xgboost").metrics)


def mod5_predict(spark, d):
    data = model_table(spark, d)
    model = models.train(data, "random_forest", TX_FEATURES)
    # The odd tree that never met the deciding column moves a score by a hundredth: one decimal is what the rule says.
    return rounded(models.predict(model, data).select("event_id", "prediction", "score"), 1)


def mod7_cross_validate(spark, d):
    return rounded(selection.cross_validate(model_table(spark, d), ["event_id"], "logistic_regression", TX_FEATURES).summary)


def mod8_tune(spark, d):
    return rounded(selection.tune(shared_rule_table(spark, d), ["event_id"], "random_forest", ["source_code", "seo_share"]).candidates)


def mod11_compare(spark, d):
    result = comparison.train_and_compare(ruled(spark, d), ["event_id"])
    comparison.save_json_summary(result, f"{work_dir(spark)}/{etl.run_name()}", "ecommerce")
    return rounded(result.board)


def mod12_save_and_load(spark, d):
    """Rows scored, and rows whose score changes after the model is stored and read back."""
    data = model_table(spark, d)
    model = models.train(data, "random_forest", TX_FEATURES)
    path = f"{work_dir(spark)}/{etl.run_name()}/model"
    models.save_model(model, path)
    again = models.predict(models.load_model(path), data).select("event_id", F.col("score").alias("again"))
    both = models.predict(model, data).join(again, "event_id")
    return both.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.abs(F.col("score") - F.col("again")) > 1e-12).alias("n_changed")
    )


# Rows as a model has to judge them that has learnt the rule.
RULED = (
    TX
    + f""", ruled as (select * replace (case when source = 'SEO' then 1 else 0 end as class) from tx),
learnt as (select *, class as prediction, cast(class as double) as score,
    case when row_number() over (partition by class order by {hash32_sql(EVENT_KEY, 42)}, event_id)
      <= floor(count(*) over (partition by class) * 0.2 + 0.5) then 'test' else 'train' end as split,
    cast((row_number() over (partition by class order by {hash32_sql(EVENT_KEY, 42)}, event_id) - 1) % 5 as int) as fold from ruled)"""
)
RULED_METRICS = with_ctes(
    RULED + ", " + metric_ctes("learnt", ["split"]),
    f"select split, metric, round(value, 6) as value from ({long_metrics(['split'])})",
)
RULED_FOLDS = (
    RULED + ", " + metric_ctes("learnt", ["fold"], "f_") + f", fm as ({long_metrics(['fold'], 'f_')})"
)
TUNED = with_ctes(
    RULED_FOLDS,
    "select '{''n_estimators'': ' || n || ', ''max_depth'': ' || d || ', ''min_samples_leaf'': ' || l || '}' as params,"
    " round(avg(value), 6) as mean_score, round(stddev_pop(value), 6) as std_score"
    " from fm, unnest([100, 200, 300]) a(n), unnest(['10', '20', 'None']) b(d), unnest([1, 2, 4]) c(l)"
    " where metric = 'f1' group by n, d, l",
)


def _compared_sql() -> str:
    """Every candidate judges test rows, and rows of the training part by fold, as the rule says."""
    names = union_sql(
        [
            f"select '{c.name}' as model_name, '{c.model_type}' as model_type, cast({c.interpretability} as double) as interpretability_score"
            for c in comparison.CANDIDATES
        ]
    )
    ctes = RULED + f""", candidates as ({names}),
  tested as (select candidates.*, learnt.* from learnt, candidates where split = 'test'),
  scored as (select candidates.*, learnt.* from learnt, candidates where split = 'train')"""
    parts = [ctes, metric_ctes("tested", MODEL_IDS, "t_"), metric_ctes("scored", ["model_name", "fold"], "f_"), FOLD_SUMMARY]
    return _leaderboard_sql(ctes=", ".join(parts))


P = PRED + ", " + metric_ctes("pred", [])

QUERIES = {
    "met1_scores": (
        met1_scores,
        with_ctes(P, "select round(accuracy, 6) as accuracy, round(precision, 6) as precision, round(recall, 6) as recall,"
                  " round(f1, 6) as f1 from metrics"),
    ),
    "met1_evaluate_all": (
        met1_evaluate_all,
        with_ctes(P, f"select metric, round(value, 6) as value from ({long_metrics([])})"),
    ),
    "met2_roc_auc": (met2_roc_auc, with_ctes(P, "select round(roc_auc, 6) as roc_auc from metrics")),
    "met2_roc_auc_one_class": (
        met2_roc_auc_one_class,
        "select cast(null as double) as roc_auc, cast(null as double) as pr_auc from (select count(*) from events)",
    ),
    "met3_average_precision": (met3_average_precision, with_ctes(P, "select round(pr_auc, 6) as pr_auc from metrics")),
    "met4_confusion": (
        met4_confusion,
        with_ctes(
            P,
            "select 0 as actual, 0 as predicted, tn as n from cells union all select 0, 1, fp from cells"
            " union all select 1, 0, fn from cells union all select 1, 1, tp from cells",
        ),
    ),
    "met5_report": (
        met5_report,
        with_ctes(
            P
            + """, lines as (
  select '0' as row, tn / (tn + fn) as precision, tn / (tn + fp) as recall, 2 * tn / (2 * tn + fp + fn) as f1, tn + fp as support from cells
  union all select '1', tp / (tp + fp), tp / (tp + fn), 2 * tp / (2 * tp + fp + fn), tp + fn from cells),
  report as (select * from lines
  union all select 'accuracy', accuracy, accuracy, accuracy, (select count(*) from pred) from metrics
  union all select 'macro avg', avg(precision), avg(recall), avg(f1), cast(sum(support) as bigint) from lines
  union all select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), cast(sum(support) as bigint) from lines)""",
            'select "row", round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support from report',
        ),
    ),
    "mod7_folds": (mod7_folds, with_ctes(FOLDED, "select event_id, class, fold from folded")),
    "mod7_fold_metrics": (
        mod7_fold_metrics,
        with_ctes(
            SCORED + ", " + metric_ctes("scored", ["model_name", "fold"], "f_"),
            f"select model_name, fold, metric, round(value, 6) as value from ({long_metrics(['model_name', 'fold'], 'f_')})",
        ),
    ),
    "mod7_fold_summary": (
        mod7_fold_summary,
        with_ctes(
            ", ".join([SCORED, metric_ctes("scored", ["model_name", "fold"], "f_"), FOLD_SUMMARY]),
            "select model_name, metric, round(mean, 6) as mean, round(std, 6) as std, round(min, 6) as min,"
            " round(max, 6) as max from fs",
        ),
    ),
    "mod9_leaderboard": (mod9_leaderboard, _leaderboard_sql()),
    "mod9_leaderboard_test_only": (mod9_leaderboard_test_only, _leaderboard_sql("pr_auc", False, 0.5, 0.5)),
    "mod9_summary": (
        mod9_summary,
        with_ctes(
            BOARD_CTES + ", " + board_sql("f1", True, 0.3, 0.7),
            "select model_name as best_model, model_type as best_model_type, round(overall_score, 6) as best_overall_score,"
            " round(performance_score, 6) as best_performance_score, interpretability_score as best_interpretability_score,"
            " round(f1, 6) as primary_metric_value, (select string_agg(model_name, ', ' order by place) from board) as ranking,"
            " (select count(*) from board) as total_models_compared from board where place = 1",
        ),
    ),
    "snk3_json_summary": (
        snk3_json_summary,
        with_ctes(
            BOARD_CTES + ", " + board_sql("f1", True, 0.3, 0.7),
            "select 'ecommerce' as dataset, model_name, round(overall_score, 6) as overall_score, cast(place as int) as place"
            " from board",
        ),
    ),
    "mod9b_profiles": (mod9b_profiles, _profiles_sql()),
    "mod10_margins": (
        mod10_margins,
        with_ctes(
            BOARD_CTES + ", " + board_sql("f1", True, 0.3, 0.7),
            "select b.model_name as best_model, o.model_name as other_model, round(b.f1 - o.f1, 6) as margin"
            " from board b, board o where b.place = 1 and o.place > 1 and b.f1 > o.f1",
        ),
    ),
    "mod1_logistic_regression": (mod1_logistic_regression, RULED_METRICS),
    "mod2_random_forest": (mod2_random_forest, RULED_METRICS),
    "mod3_gradient_boosting": (mod3_gradient_boosting, RULED_METRICS),
    "mod5_predict": (mod5_predict, with_ctes(RULED, "select event_id, prediction, score from learnt")),
    "mod7_cross_validate": (
        mod7_cross_validate,
        with_ctes(
            RULED_FOLDS,
            "select metric, round(avg(value), 6) as mean, round(stddev_pop(value), 6) as std, round(min(value), 6) as min,"
            " round(max(value), 6) as max from fm group by metric",
        ),
    ),
    "mod8_tune": (mod8_tune, TUNED),
    "mod11_compare": (mod11_compare, _compared_sql()),
    "mod12_save_and_load": (
        mod12_save_and_load,
        "select count(*) as n_rows, cast(0 as bigint) as n_changed from events",
    ),
}
