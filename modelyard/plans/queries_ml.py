"""Registered queries: Spark ML candidates, barrier shards, per-group fits.

Fitted Spark ML models are iterative and seeded, so most of these get the
rows-only check; the assembled features, shard sums and per-group least
squares are exact and carry DuckDB oracles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.metrics import REGRESSION_METRICS
from ..functions.numeric import round_sig, round_sig_sql
from ..operators.batching import shard
from ..operators.classify import auc_from_roc, roc_points
from ..operators.gang import gang_map, grouped_least_squares, shard_partials
from ..operators.measure import (binary_metrics, fold_summary, leaderboard,
                                 regression_metrics, rounded)
from ..operators.spark_models import (classifiers, fit_candidates, fit_fold_candidates,
                                      fold_predictions, fold_scores, iterative_regressors,
                                      long_predictions, regressors, scoring_history, timings)
from ..operators.split import hash_split_col, kfold_col, kfold_sql, stratified_kfold
from ..registry import register
from ..session import scratch_path
from ..sources.tables import load_table
from .queries_classify import labelled_docs
from .queries_core import (PART_FEATURES, PART_KEYS, PART_LABEL, _part_split_cte,
                           part_trial)
from .sqltext import regression_metrics_sql

R = round_sig_sql
K = 5

ASSEMBLED_SQL = "SELECT p_partkey, CAST(p_partkey AS DOUBLE) AS f0, CAST(p_size AS DOUBLE) AS f1, " \
                "CAST(2 AS INTEGER) AS n_features FROM part"


@register("assembled_features", "F1", ASSEMBLED_SQL)
def assembled_features(spark, sf_dir):
    """Every numeric column except the label goes into the feature vector."""
    from pyspark.ml.functions import vector_to_array
    from ..operators.features import assemble
    part = load_table(spark, sf_dir, "part")
    v = assemble(part, PART_LABEL).select("p_partkey", vector_to_array("features").alias("a"))
    return v.select("p_partkey", F.col("a")[0].alias("f0"), F.col("a")[1].alias("f1"),
                    F.size("a").alias("n_features"))


def _part_features(spark, sf_dir):
    from pyspark.ml.feature import VectorAssembler
    t = part_trial(spark, sf_dir)
    asm = VectorAssembler(inputCols=PART_FEATURES, outputCol="features")
    return t, asm


@register("automl_leaderboard", "M2 M5 M8 M10 E1 E14")
def automl_leaderboard(spark, sf_dir):
    """Spark ML regressors (linear, GLM, tree, forest, GBT) ranked on the hold-out."""
    t, asm = _part_features(spark, sf_dir)
    models = fit_candidates(t.train, [asm], regressors(PART_LABEL, seed=1), max_models=5)
    preds = long_predictions(models, t.holdout, PART_KEYS, PART_LABEL)
    board = leaderboard(regression_metrics(preds))
    return board.join(timings(spark, models), "model_id")


@register("scoring_history", "E10")
def scoring_history_q(spark, sf_dir):
    """Loss per boosting iteration on the hold-out; objective per solver step."""
    t, asm = _part_features(spark, sf_dir)
    models = fit_candidates(t.train, [asm], iterative_regressors(PART_LABEL, seed=1))
    hold = asm.transform(t.holdout)
    rows = []
    for mid, (pm, _) in models.items():
        for it, metric, v in scoring_history(pm.stages[-1], hold, PART_LABEL):
            rows.append((mid, it, metric, v))
    return spark.createDataFrame(rows, "model_id string, iteration int, metric string, value double")


@register("autolog_trial", "T7 T2 T3 T4 T9")
def autolog_trial(spark, sf_dir):
    """Fit two Spark ML candidates and log runs, params and metrics in one append."""
    from ..operators.tracking import autolog, read_log
    t, asm = _part_features(spark, sf_dir)

    def fit():
        models = fit_candidates(t.train, [asm], regressors(PART_LABEL, seed=1), max_models=2)
        board = leaderboard(regression_metrics(long_predictions(models, t.holdout, PART_KEYS,
                                                                PART_LABEL)))
        board = board.join(timings(spark, models), "model_id")
        params = spark.createDataFrame(
            [(mid, {p.name: str(v) for p, v in pm.stages[-1].extractParamMap().items()})
             for mid, (pm, _) in models.items()], "model_id string, params map<string,string>")
        return params, board

    path = autolog(fit, "autolog", "automl", scratch_path(spark, "autolog"),
                   ["mse", "rmse", "mae", "r2", "train_seconds"], {"source": "modelyard"}, trial="automl")
    return read_log(spark, path)


@register("automl_cv_leaderboard", "M2 M14 E8 R4")
def automl_cv_leaderboard(spark, sf_dir):
    """Spark ML candidates ranked by 5-fold CV RMSE: all candidates and folds in one pool."""
    t, asm = _part_features(spark, sf_dir)
    per_fold = cv_metrics(t.train.withColumn("fold", kfold_col(PART_KEYS, K, 1)), [asm],
                          regressors(PART_LABEL, seed=1))
    cv = fold_summary(per_fold, ["rmse"]).select(
        "model_id", F.col("rmse_mean").alias("rmse"), "rmse_sd", F.col("folds").cast("int").alias("folds"))
    return leaderboard(cv, "rmse")


def cv_metrics(train, stages, candidates):
    """Every regression metric per (model, fold), each row scored by the models that did not see it."""
    fitted = fit_fold_candidates(train, stages, candidates, "fold", K)
    return regression_metrics(fold_predictions(fitted, train, "fold", PART_KEYS, PART_LABEL),
                              ["model_id", "fold"])


CV_REGRESSORS_SQL = f"""
WITH {_part_split_cte()},
ft AS (SELECT CAST({PART_LABEL} AS DOUBLE) AS y, CAST({PART_FEATURES[0]} AS DOUBLE) AS x1,
              CAST({PART_FEATURES[1]} AS DOUBLE) AS x2, {kfold_sql(PART_KEYS, 5, 1)} AS fold FROM train),
mom AS (SELECT f, avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS v1, var_pop(x2) AS v2,
               covar_pop(x1, x2) AS c12, covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2
        FROM ft JOIN (SELECT DISTINCT fold AS f FROM ft) g ON ft.fold <> g.f GROUP BY f),
co AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1,
              (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM mom),
pred AS (SELECT fold, y, my + b1 * (x1 - m1) + b2 * (x2 - m2) AS p FROM ft JOIN co ON fold = f)
SELECT model_id, fold, {regression_metrics_sql('y', 'p', 7)}
FROM pred, (VALUES ('linear'), ('glm')) m(model_id) GROUP BY model_id, fold
"""


@register("cv_regressor_metrics", "M14 E8 M2", CV_REGRESSORS_SQL)
def cv_regressor_metrics(spark, sf_dir):
    """Linear regression and the Gaussian GLM per fold, equal to least squares on the other folds."""
    t, asm = _part_features(spark, sf_dir)
    exact = [c for c in regressors(PART_LABEL, seed=1) if c[0] in ("linear", "glm")]
    per_fold = cv_metrics(t.train.withColumn("fold", kfold_col(PART_KEYS, K, 1)), [asm], exact)
    return rounded(per_fold, REGRESSION_METRICS, 7)


@register("spark_model_details", "E11 E12 M12")
def spark_model_details(spark, sf_dir):
    """Linear coefficients and tree importances (relative, scaled, share) of the candidates."""
    from pyspark.sql import Window
    from ..operators.spark_models import model_details
    t, asm = _part_features(spark, sf_dir)
    models = fit_candidates(t.train, [asm], regressors(PART_LABEL, seed=1), max_models=5)
    d = spark.createDataFrame(model_details(models, PART_FEATURES),
                              "model_id string, kind string, name string, value double")
    w = Window.partitionBy("model_id", "kind")
    imp = F.col("kind") == "importance"
    return d.select("model_id", "kind", "name", "value",
                    F.when(imp, F.try_divide(F.col("value"), F.max("value").over(w))).alias("scaled"),
                    F.when(imp, F.try_divide(F.col("value"), F.sum("value").over(w))).alias("share"))


def _doc_features(spark, sf_dir, k: int = 3):
    """labels + documents with stratified folds and (n_chars, one-hot lang) features."""
    from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
    d = stratified_kfold(labelled_docs(spark, sf_dir), "quality", ["doc_id"], k=k, seed=1)
    d = d.withColumn("quality", F.col("quality").cast("double"))
    # n_chars spans four orders of magnitude next to 0/1 indicators: scale to
    # unit variance (statistics from the fold's train rows) so the linear
    # solvers converge.
    stages = [StringIndexer(inputCol="lang", outputCol="lang_idx", handleInvalid="keep",
                            stringOrderType="alphabetAsc"),
              OneHotEncoder(inputCols=["lang_idx"], outputCols=["lang_vec"], handleInvalid="keep"),
              VectorAssembler(inputCols=["n_chars", "lang_vec"], outputCol="raw_features"),
              StandardScaler(inputCol="raw_features", outputCol="features", withMean=False)]
    return d, stages


@register("classifier_comparison", "M5 M11 E2 E3 E6 E14 R5")
def classifier_comparison(spark, sf_dir):
    """Six Spark ML classifiers, 3-fold stratified CV; mean and sd over folds of the best 5."""
    k = 3
    d, stages = _doc_features(spark, sf_dir, k)
    fitted = fit_fold_candidates(d, stages, classifiers("quality", seed=1), "fold", k)
    secs = {}
    for (_, mid), (_, s) in fitted.items():
        secs[mid] = secs.get(mid, 0.0) + s
    by = ["model_id", "fold"]
    preds = fold_scores(fitted, d, "fold", ["doc_id"], "quality")
    auc = auc_from_roc(roc_points(preds, "label", "score", by), by)
    per_fold = binary_metrics(preds, by).join(auc, by)
    grid = fold_summary(per_fold, ["accuracy", "auc", "recall", "precision", "f1", "kappa", "mcc"])
    tt = spark.createDataFrame([(m, s / k) for m, s in secs.items()], "model_id string, TT_Sec double")
    return leaderboard(grid.join(tt, "model_id"), "accuracy_mean",
                       ascending=False).where(F.col("rank") <= 5)


@register("dense_network", "M7 E2 E7 P5")
def dense_network(spark, sf_dir):
    """Multilayer perceptron 64-64-10 on the embedding arrays, 5 solver iterations.

    Not the reference network: Spark's perceptron has sigmoid hidden units
    and a full-batch L-BFGS solver, so 5 iterations are not 5 mini-batch steps.
    """
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.functions import array_to_vector, vector_to_array
    e = load_table(spark, sf_dir, "embeddings").select(
        "vec_id", F.col("label").cast("double").alias("label"),
        array_to_vector("embedding").alias("features"),
        hash_split_col(["vec_id"], [0.8, 0.2], 1).alias("split"))
    mlp = MultilayerPerceptronClassifier(layers=[64, 64, 10], blockSize=64, maxIter=5, seed=1)
    model = mlp.fit(e.where(F.col("split") == 0))
    p = model.transform(e).withColumn("prob", vector_to_array("probability"))
    p_true = F.try_element_at("prob", (F.col("label") + 1).cast("int"))
    return p.groupBy("split").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("accuracy"),
        (-F.avg(F.ln(F.greatest(p_true, F.lit(1e-7))))).alias("log_loss"))


SHARD_SUMS_SQL = """
WITH s AS (SELECT (row_number() OVER (ORDER BY vec_id) - 1) % 4 AS shard, label FROM embeddings)
SELECT CAST(shard AS INTEGER) AS shard, count(*) AS n, CAST(sum(label) AS BIGINT) AS label_sum
FROM s GROUP BY shard
"""


@register("gang_shard_sums", "U1 R9", SHARD_SUMS_SQL)
def gang_shard_sums(spark, sf_dir):
    """4 gang-scheduled tasks, one per shard; partial sums combined by Spark."""
    e = load_table(spark, sf_dir, "embeddings").select("vec_id", "label")
    sh = shard(e, ["vec_id"], 4, repartition=False)
    parts = gang_map(sh, shard_partials("shard", "label"),
                     "shard int, n long, label_sum long", n_tasks=4, key="shard")
    return parts.groupBy("shard").agg(F.sum("n").alias("n"), F.sum("label_sum").alias("label_sum"))


GROUPED_LSQ_SQL = f"""
WITH {_part_split_cte()},
ft AS (SELECT *, {kfold_sql(PART_KEYS, 5, 1)} AS fold FROM train)
SELECT fold, count(*) AS n,
       {R('regr_slope(CAST(p_retailprice AS DOUBLE), CAST(p_partkey AS DOUBLE))')} AS slope,
       {R('regr_intercept(CAST(p_retailprice AS DOUBLE), CAST(p_partkey AS DOUBLE))')} AS intercept
FROM ft GROUP BY fold
"""


@register("grouped_least_squares", "U2 M14", GROUPED_LSQ_SQL)
def grouped_least_squares_q(spark, sf_dir):
    """Least squares per fold fitted in pandas batch by batch, merged exactly."""
    t = part_trial(spark, sf_dir)
    tr = t.train.withColumn("fold", kfold_col(PART_KEYS, 5, 1))
    out = grouped_least_squares(tr, ["fold"], "p_partkey", PART_LABEL)
    return out.select("fold", "n", round_sig("slope").alias("slope"),
                      round_sig("intercept").alias("intercept"))
