"""Registered queries: model listing, params, folds, CV, current metrics, refit."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions.ids import key_md5
from ..functions.metrics import REGRESSION_METRICS
from ..functions.numeric import round_sig, round_sig_sql
from ..operators.closed_form import (coefficients_frame, correlation_importance,
                                     fit_closed_form, fit_fold_models, measure_cv,
                                     measure_wide, models_frame, score_long)
from ..operators.measure import METRIC_REGISTRY, best_n, fold_summary, metric_registry, rounded
from ..operators.split import kfold_col, kfold_sql
from ..registry import register
from ..sources.tables import load_table
from .queries_core import (PART_FEATURES, PART_FILTER, PART_KEYS, PART_LABEL,
                           REGRESSION_LEADERBOARD_SQL, _part_split_cte, part_trial,
                           split_cte)
from .queries_core import LI_FEATURES, LI_FILTER, LI_KEYS, LI_LABEL
from .regression import split_frame
from .sqltext import closed_form_coef_sql, closed_form_preds_sql, regression_metrics_sql

R = round_sig_sql
K = 5
FOLD_SQL = kfold_sql(PART_KEYS, K, 1)


@register("best_models", "M11", f"SELECT * FROM ({REGRESSION_LEADERBOARD_SQL}) WHERE rank <= 2")
def best_models(spark, sf_dir):
    """The best 2 candidates (``maxModels=2``) of the regression trial."""
    return best_n(part_trial(spark, sf_dir).board, 2)


SCORE_ROWS_SQL = f"""
WITH {_part_split_cte()},
pred AS ({closed_form_preds_sql('hold', PART_LABEL, PART_FEATURES, PART_KEYS)})
SELECT p_partkey, model_id, y AS label, {R('p')} AS prediction FROM pred
"""


@register("score_all_models", "M8 M9", SCORE_ROWS_SQL)
def score_all_models(spark, sf_dir):
    """Every hold-out row scored by every candidate (bare models, no filter)."""
    t = part_trial(spark, sf_dir)
    long = score_long(t.holdout, t.models, PART_LABEL, PART_KEYS)
    return long.withColumn("prediction", round_sig("prediction"))


def _models_with_paths(spark, sf_dir):
    t = part_trial(spark, sf_dir)
    exp_id = key_md5([F.lit("part")], "experiment")
    return t, models_frame(spark, t.models).withColumn("experiment_id", exp_id)


MODEL_LIST_SQL = f"""
WITH {_part_split_cte()}
SELECT model_id, algo, n_coefficients, {R('intercept')} AS intercept,
       concat_ws('/', 'artifacts', md5(concat_ws('|', 'experiment', 'part')), model_id) AS artifact_path
FROM (
  SELECT 'mean' AS model_id, 'constant_mean' AS algo, 0 AS n_coefficients, m AS intercept FROM coef
  UNION ALL SELECT 'lsq_p_partkey', 'least_squares', CASE WHEN b0 IS NULL THEN 0 ELSE 1 END,
                   CASE WHEN b0 IS NULL THEN m ELSE a0 END FROM coef
  UNION ALL SELECT 'lsq_p_size', 'least_squares', CASE WHEN b1 IS NULL THEN 0 ELSE 1 END,
                   CASE WHEN b1 IS NULL THEN m ELSE a1 END FROM coef)
"""


@register("model_list", "M12 P12", MODEL_LIST_SQL)
def model_list(spark, sf_dir):
    """All fitted candidates with their artifact paths."""
    _, mf = _models_with_paths(spark, sf_dir)
    return mf.select("model_id", "algo", F.size("coefficients").alias("n_coefficients"),
                     round_sig("intercept").alias("intercept"),
                     F.concat_ws("/", F.lit("artifacts"), "experiment_id", "model_id")
                     .alias("artifact_path"))


TRAINING_PARAMS_SQL = f"""
WITH {_part_split_cte()},
n AS (SELECT CAST(count({PART_LABEL}) AS VARCHAR) AS v FROM train)
SELECT model_id, key, value FROM (
  SELECT 'mean' AS model_id, 'label' AS key, '{PART_LABEL}' AS value
  UNION ALL SELECT 'mean', 'model_id', 'mean'
  UNION ALL SELECT 'mean', 'train_rows', v FROM n
""" + "".join(f"""
  UNION ALL SELECT 'lsq_{f}', 'label', '{PART_LABEL}'
  UNION ALL SELECT 'lsq_{f}', 'model_id', 'lsq_{f}'
  UNION ALL SELECT 'lsq_{f}', 'feature', '{f}'
  UNION ALL SELECT 'lsq_{f}', 'train_rows', v FROM n""" for f in PART_FEATURES) + ")"


@register("training_params", "M13 P6", TRAINING_PARAMS_SQL)
def training_params(spark, sf_dir):
    """Each candidate's training parameters as string rows."""
    _, mf = _models_with_paths(spark, sf_dir)
    return mf.select("model_id", F.explode("params").alias("key", "value"))


def cv_cte(table: str, label: str, features: list[str], keys: list[str], where: str,
           k: int = K) -> str:
    """SQL of out-of-fold predictions and per-fold metrics for the closed-form candidates."""
    coef = closed_form_coef_sql(label, features)
    preds = [f"SELECT t.fold, 'mean' AS model_id, CAST({label} AS DOUBLE) AS y, c.m AS p "
             f"FROM ftrain t JOIN cvc c ON t.fold = c.fold"]
    for i, f in enumerate(features):
        preds.append(
            f"SELECT t.fold, 'lsq_{f}', CAST({label} AS DOUBLE), "
            f"CASE WHEN c.b{i} IS NULL THEN c.m ELSE c.a{i} + c.b{i} * CAST(t.{f} AS DOUBLE) END "
            f"FROM ftrain t JOIN cvc c ON t.fold = c.fold")
    union = "\nUNION ALL\n".join(preds)
    return f"""{split_cte(table, label, features, keys, where)},
ftrain AS (SELECT *, {kfold_sql(keys, k, 1)} AS fold FROM train),
cvc AS (SELECT r.f AS fold, count({label}) AS n, {coef}
        FROM ftrain t JOIN range(0, {k}) r(f) ON t.fold <> r.f GROUP BY r.f),
cvp AS ({union}),
perfold AS (SELECT model_id, fold, count(y - p) AS n, avg((y - p) * (y - p)) AS mse,
                   sqrt(avg((y - p) * (y - p))) AS rmse, avg(abs(y - p)) AS mae,
                   CASE WHEN min(least(y, p)) > -1 THEN sqrt(avg((ln(1 + y) - ln(1 + p)) * (ln(1 + y) - ln(1 + p)))) END AS rmsle,
                   CASE WHEN var_pop(y) > 0 THEN 1 - {R('avg((y - p) * (y - p)) / var_pop(y)', 12)} END AS r2,
                   avg((y - p) * (y - p)) AS mean_residual_deviance
            FROM cvp GROUP BY model_id, fold)"""


def _cv_cte() -> str:
    return cv_cte("part", PART_LABEL, PART_FEATURES, PART_KEYS, PART_FILTER)


FOLD_MODELS_SQL = f"""
WITH {_cv_cte()}
SELECT model_id, CAST(fold AS INTEGER) AS fold, {R('intercept')} AS intercept, {R('slope')} AS slope,
       train_rows FROM (
  SELECT 'mean' AS model_id, fold, m AS intercept, CAST(NULL AS DOUBLE) AS slope, n AS train_rows FROM cvc
""" + "".join(f"""
  UNION ALL SELECT 'lsq_{f}', fold, CASE WHEN b{i} IS NULL THEN m ELSE a{i} END, b{i}, n FROM cvc"""
              for i, f in enumerate(PART_FEATURES)) + ")"


def _fold_train(spark, sf_dir):
    t = part_trial(spark, sf_dir)
    return t, t.train.withColumn("fold", kfold_col(PART_KEYS, K, 1))


@register("fold_models", "M14 R4", FOLD_MODELS_SQL)
def fold_models(spark, sf_dir):
    """Candidates refitted once per fold on the other folds."""
    t, tr = _fold_train(spark, sf_dir)
    fm = fit_fold_models(tr, PART_LABEL, PART_FEATURES, "fold", K)
    rows = []
    for fold, ms in fm.items():
        for m in ms:
            slope = m.coefficients[0][1] if m.coefficients else None
            rows.append((m.model_id, fold, float(m.intercept), slope, int(m.params["train_rows"])))
    df = spark.createDataFrame(rows, "model_id string, fold int, intercept double, slope double, "
                                     "train_rows bigint")
    return rounded(df, ["intercept", "slope"])


_CV_SUMMARY_COLS = ", ".join(
    f"{R(f'avg({m})')} AS {m}_mean, {R(f'stddev_pop({m})')} AS {m}_sd" for m in REGRESSION_METRICS)
CV_METRICS_SQL = f"""
WITH {_cv_cte()}
SELECT model_id, count(*) AS folds, {_CV_SUMMARY_COLS} FROM perfold GROUP BY model_id
"""


def _cv_summary(spark, sf_dir):
    t, tr = _fold_train(spark, sf_dir)
    fm = fit_fold_models(tr, PART_LABEL, PART_FEATURES, "fold", K)
    return t, fold_summary(measure_cv(tr, fm, PART_LABEL, "fold"))


@register("cv_metrics", "E8 M14", CV_METRICS_SQL)
def cv_metrics(spark, sf_dir):
    """Out-of-fold metrics per candidate: mean and population sd over 5 folds."""
    _, summary = _cv_summary(spark, sf_dir)
    return rounded(summary, [c for c, t in summary.dtypes if t == "double"])


_METRIC_LIST = ", ".join(f"'{m}'" for m in REGRESSION_METRICS)
CURRENT_METRICS_SQL = f"""
WITH {_cv_cte()},
trainp AS ({closed_form_preds_sql('train', PART_LABEL, PART_FEATURES, [])}),
holdp AS ({closed_form_preds_sql('hold', PART_LABEL, PART_FEATURES, [])}),
tm AS (SELECT model_id, {regression_metrics_sql('y', 'p')} FROM trainp GROUP BY model_id),
vm AS (SELECT model_id, {regression_metrics_sql('y', 'p')} FROM holdp GROUP BY model_id),
cm AS (SELECT model_id, {_CV_SUMMARY_COLS.replace('_mean', '').replace(', ' + R('stddev_pop(mse)') + ' AS mse_sd', '')} FROM perfold GROUP BY model_id),
tl AS (UNPIVOT (SELECT model_id, {', '.join(REGRESSION_METRICS)} FROM tm) ON {', '.join(REGRESSION_METRICS)} INTO NAME metric VALUE training),
vl AS (UNPIVOT (SELECT model_id, {', '.join(REGRESSION_METRICS)} FROM vm) ON {', '.join(REGRESSION_METRICS)} INTO NAME metric VALUE validation),
cl AS (UNPIVOT (SELECT model_id, {', '.join(REGRESSION_METRICS)} FROM cm) ON {', '.join(REGRESSION_METRICS)} INTO NAME metric VALUE cv)
SELECT tl.model_id, tl.metric, training, validation, cv,
       coalesce(cv, validation, training) AS value,
       CASE WHEN cv IS NOT NULL THEN 'cv' WHEN validation IS NOT NULL THEN 'validation' ELSE 'training' END AS source
FROM tl JOIN vl ON tl.model_id = vl.model_id AND tl.metric = vl.metric
        JOIN cl ON tl.model_id = cl.model_id AND tl.metric = cl.metric
"""


@register("current_metrics", "E9 E1 E8", CURRENT_METRICS_SQL)
def current_metrics(spark, sf_dir):
    """Per model and metric: CV mean if present, else validation, else training."""
    t, summary = _cv_summary(spark, sf_dir)
    cv = summary.select("model_id", *[F.col(f"{m}_mean").alias(m) for m in REGRESSION_METRICS])
    sources = {"training": measure_wide(t.train, t.models, PART_LABEL),
               "validation": measure_wide(t.holdout, t.models, PART_LABEL), "cv": cv}
    longs = []
    for name, df in sources.items():
        r = rounded(df.select("model_id", *REGRESSION_METRICS), REGRESSION_METRICS)
        longs.append(r.unpivot(["model_id"], REGRESSION_METRICS, "metric", name))
    j = longs[0].join(longs[1], ["model_id", "metric"]).join(longs[2], ["model_id", "metric"])
    return j.select(
        "model_id", "metric", "training", "validation", "cv",
        F.coalesce("cv", "validation", "training").alias("value"),
        F.when(F.col("cv").isNotNull(), "cv").when(F.col("validation").isNotNull(), "validation")
        .otherwise("training").alias("source"))


REFIT_SQL = f"""
WITH allrows AS (SELECT * FROM part WHERE {PART_FILTER}),
coef AS (SELECT count({PART_LABEL}) AS n, {closed_form_coef_sql(PART_LABEL, PART_FEATURES)} FROM allrows)
SELECT model_id, {R('intercept')} AS intercept, {R('slope')} AS slope, train_rows FROM (
  SELECT 'mean' AS model_id, m AS intercept, CAST(NULL AS DOUBLE) AS slope, n AS train_rows FROM coef
""" + "".join(f"""
  UNION ALL SELECT 'lsq_{f}', CASE WHEN b{i} IS NULL THEN m ELSE a{i} END, b{i}, n FROM coef"""
              for i, f in enumerate(PART_FEATURES)) + ")"


@register("refit_all_rows", "M15", REFIT_SQL)
def refit_all_rows(spark, sf_dir):
    """Candidates refitted on every filtered row (train + hold-out)."""
    part = load_table(spark, sf_dir, "part").where(PART_FILTER)
    ms = fit_closed_form(part, PART_LABEL, PART_FEATURES)
    rows = [(m.model_id, float(m.intercept), m.coefficients[0][1] if m.coefficients else None,
             int(m.params["train_rows"])) for m in ms]
    df = spark.createDataFrame(rows, "model_id string, intercept double, slope double, train_rows bigint")
    return rounded(df, ["intercept", "slope"])


COEF_SQL = f"""
WITH {_part_split_cte()},
st AS (SELECT {', '.join(f'stddev_samp(CAST({f} AS DOUBLE)) AS sd{i}, avg(CAST({f} AS DOUBLE)) AS mu{i}' for i, f in enumerate(PART_FEATURES))} FROM train)
SELECT model_id, name, {R('coefficient')} AS coefficient, {R('std_coefficient')} AS std_coefficient FROM (
  SELECT 'mean' AS model_id, 'Intercept' AS name, m AS coefficient, m AS std_coefficient FROM coef
""" + "".join(f"""
  UNION ALL SELECT 'lsq_{f}', 'Intercept', CASE WHEN b{i} IS NULL THEN m ELSE a{i} END,
                   CASE WHEN b{i} IS NULL THEN m ELSE a{i} + b{i} * mu{i} END FROM coef, st
  UNION ALL SELECT 'lsq_{f}', '{f}', b{i}, b{i} * sd{i} FROM coef, st WHERE b{i} IS NOT NULL"""
              for i, f in enumerate(PART_FEATURES)) + ")"


@register("coefficients", "E12", COEF_SQL)
def coefficients(spark, sf_dir):
    t = part_trial(spark, sf_dir)
    return rounded(coefficients_frame(t.train, t.models), ["coefficient", "std_coefficient"])


IMPORTANCE_SQL = f"""
WITH {_part_split_cte()},
c AS ({' UNION ALL '.join(f"SELECT '{f}' AS variable, abs(corr(CAST({f} AS DOUBLE), CAST({PART_LABEL} AS DOUBLE))) AS r FROM train" for f in PART_FEATURES)})
SELECT variable, {R('r')} AS relative_importance, {R('r / max(r) OVER ()')} AS scaled_importance,
       {R('r / sum(r) OVER ()')} AS percentage
FROM c
"""


@register("feature_importance", "E11", IMPORTANCE_SQL)
def feature_importance(spark, sf_dir):
    """|corr(feature, label)| on train rows, scaled by the max and by the sum."""
    t = part_trial(spark, sf_dir)
    imp = correlation_importance(t.train, PART_LABEL, PART_FEATURES)
    return rounded(imp, ["relative_importance", "scaled_importance", "percentage"])


_REG_VALUES = ", ".join(f"('{i}', '{n}', {str(g).upper()})" for i, n, g, _ in METRIC_REGISTRY)
METRIC_RANKS_SQL = f"""
WITH lb AS ({REGRESSION_LEADERBOARD_SQL}),
reg AS (SELECT * FROM (VALUES {_REG_VALUES}) v(id, name, greater_is_better)),
long AS (UNPIVOT (SELECT model_id, {', '.join(REGRESSION_METRICS)} FROM lb)
         ON {', '.join(REGRESSION_METRICS)} INTO NAME metric VALUE value)
SELECT l.metric, r.name, r.greater_is_better, l.model_id, l.value,
       CAST(row_number() OVER (PARTITION BY l.metric ORDER BY
            CASE WHEN r.greater_is_better THEN -l.value ELSE l.value END NULLS LAST, l.model_id) AS INTEGER) AS metric_rank
FROM long l JOIN reg r ON l.metric = r.id
"""


@register("metric_ranks", "E13 M10 T4", METRIC_RANKS_SQL)
def metric_ranks(spark, sf_dir):
    """Leaderboard in long form joined to the metric registry; rank per metric."""
    board = part_trial(spark, sf_dir).board
    long = board.unpivot(["model_id"], REGRESSION_METRICS, "metric", "value")
    reg = metric_registry(spark).select(F.col("id").alias("metric"), "name", "greater_is_better")
    j = long.join(F.broadcast(reg), "metric")  # registry: fixed 14 rows
    key = F.when(F.col("greater_is_better"), -F.col("value")).otherwise(F.col("value"))
    w = Window.partitionBy("metric").orderBy(key.asc_nulls_last(), F.col("model_id"))
    return j.select("metric", "name", "greater_is_better", "model_id", "value",
                    F.row_number().over(w).alias("metric_rank"))


LINEITEM_CV_SQL = f"""
WITH {cv_cte("lineitem", LI_LABEL, LI_FEATURES, LI_KEYS, LI_FILTER)}
SELECT model_id, count(*) AS folds, {_CV_SUMMARY_COLS} FROM perfold GROUP BY model_id
"""


@register("lineitem_cv_metrics", "E8 M14 R4", LINEITEM_CV_SQL)
def lineitem_cv_metrics(spark, sf_dir):
    """5-fold out-of-fold metrics of the closed-form candidates on lineitem."""
    li = load_table(spark, sf_dir, "lineitem").select(*LI_KEYS, LI_LABEL, *LI_FEATURES)
    train = split_frame(li, LI_KEYS, 0.8, 1)[0].where(LI_FILTER)
    tr = train.withColumn("fold", kfold_col(LI_KEYS, K, 1))
    fm = fit_fold_models(tr, LI_LABEL, LI_FEATURES, "fold", K)
    summary = fold_summary(measure_cv(tr, fm, LI_LABEL, "fold"))
    return rounded(summary, [c for c, t in summary.dtypes if t == "double"])


@register("present_slopes", "P15 M14", f"SELECT * FROM ({FOLD_MODELS_SQL}) WHERE slope IS NOT NULL")
def present_slopes(spark, sf_dir):
    """Fold models that have a slope; the constant model has none and is left out."""
    from ..operators.measure import present_only
    return present_only(fold_models(spark, sf_dir), ["slope"])
