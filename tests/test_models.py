"""Closed-form candidates, fold models, the pipeline estimator, Spark ML candidates."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from modelyard.operators.closed_form import (coefficients_frame, fit_closed_form,
                                             fit_fold_models, measure_cv, measure_wide,
                                             score_long)
from modelyard.operators.estimators import LeastSquaresRegressor
from modelyard.operators.measure import regression_metrics


def _linear(spark, n=200):
    rng = np.random.default_rng(1)
    x = rng.uniform(0, 10, n)
    z = np.full(n, 3.0)                      # a constant feature
    y = 2.0 + 0.5 * x + rng.normal(0, 0.1, n)
    return spark.createDataFrame(pd.DataFrame({"k": np.arange(n), "x": x, "z": z, "y": y}))


def test_fit_recovers_line_and_constant_feature_falls_back(spark):
    df = _linear(spark)
    ms = {m.model_id: m for m in fit_closed_form(df, "y", ["x", "z"])}
    lsq = ms["lsq_x"]
    assert math.isclose(lsq.coefficients[0][1], 0.5, abs_tol=0.01)
    assert math.isclose(lsq.intercept, 2.0, abs_tol=0.05)
    assert ms["lsq_z"].coefficients == ()    # no slope on a constant: the mean model
    assert math.isclose(ms["lsq_z"].intercept, ms["mean"].intercept)


def test_wide_and_long_measurement_agree(spark):
    df = _linear(spark)
    ms = fit_closed_form(df, "y", ["x"])
    wide = {r["model_id"]: r for r in measure_wide(df, ms, "y").collect()}
    long = {r["model_id"]: r for r in regression_metrics(score_long(df, ms, "y", ["k"])).collect()}
    for mid in wide:
        for c in ["n", "mse", "mae", "r2"]:
            assert math.isclose(wide[mid][c], long[mid][c], rel_tol=1e-9, abs_tol=1e-12)


def test_mean_model_r2_zero_on_own_rows(spark):
    df = _linear(spark)
    ms = fit_closed_form(df, "y", [])
    assert measure_wide(df, ms, "y").first()["r2"] == 0.0


def test_fold_models_match_direct_fits(spark):
    df = _linear(spark).withColumn("fold", (F.col("k") % 3).cast("int"))
    fm = fit_fold_models(df, "y", ["x"], "fold", 3)
    for fold in range(3):
        direct = fit_closed_form(df.where(F.col("fold") != fold), "y", ["x"])
        assert math.isclose(fm[fold][1].coefficients[0][1], direct[1].coefficients[0][1],
                            rel_tol=1e-9)
    cv = measure_cv(df, fm, "y", "fold").toPandas()
    assert set(cv["fold"]) == {0, 1, 2} and (cv["n"] > 0).all()


def test_cv_reads_only_a_models_own_features(spark):
    df = spark.range(30).select(
        F.col("id").alias("k"), F.col("id").cast("double").alias("x"),
        F.when(F.col("id") % 2 == 0, F.sqrt("id")).alias("z"),
        (F.col("id") * 3.0).alias("y"), (F.col("id") % 3).cast("int").alias("fold"))
    fm = fit_fold_models(df, "y", ["x", "z"], "fold", 3)
    n = {r["model_id"]: r["n"] for r in measure_cv(df, fm, "y", "fold").groupBy("model_id")
         .agg(F.sum("n").alias("n")).collect()}
    assert n == {"mean": 30, "lsq_x": 30, "lsq_z": 15}


def test_fold_scores_are_probabilities_or_margins(spark):
    from pyspark.ml.feature import VectorAssembler
    from modelyard.operators.classify import auc_from_roc, roc_points
    from modelyard.operators.spark_models import classifiers, fit_fold_candidates, fold_scores
    df = spark.range(120).select(
        F.col("id").alias("k"), (F.col("id") % 10).cast("double").alias("x"),
        (F.col("id") % 10 >= 5).cast("double").alias("y"), (F.floor(F.col("id") / 10) % 2).cast("int").alias("fold"))
    some = [c for c in classifiers("y") if c[0] in ("logistic", "linear_svc")]
    fitted = fit_fold_candidates(df, [VectorAssembler(inputCols=["x"], outputCol="features")], some, "fold", 2)
    preds = fold_scores(fitted, df, "fold", ["k"], "y")
    assert preds.count() == 240
    roc = roc_points(preds, "label", "score", ["model_id", "fold"])
    assert [r["auc"] for r in auc_from_roc(roc, ["model_id", "fold"]).collect()] == [1.0] * 4


def test_coefficients_standardised(spark):
    df = _linear(spark)
    ms = fit_closed_form(df, "y", ["x"])
    rows = {(r["model_id"], r["name"]): r for r in coefficients_frame(df, ms).collect()}
    sd = df.agg(F.stddev_samp("x")).first()[0]
    c = rows[("lsq_x", "x")]
    assert math.isclose(c["std_coefficient"], c["coefficient"] * sd)


def test_pipeline_filter_replays_at_predict_time_and_reloads(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import SQLTransformer
    df = _linear(spark)
    pipe = Pipeline(stages=[SQLTransformer(statement="SELECT * FROM __THIS__ WHERE x > 5"),
                            LeastSquaresRegressor(featureCol="x", labelCol="y")])
    model = pipe.fit(df)
    out = model.transform(df)
    assert out.count() == df.where("x > 5").count()   # low rows vanish from predictions
    path = str(tmp_path / "m")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(df)
    a = {r["k"]: r["prediction"] for r in out.collect()}
    b = {r["k"]: r["prediction"] for r in again.collect()}
    assert a == b


def test_spark_ml_candidates_beat_constant(spark):
    from pyspark.ml.feature import VectorAssembler
    from modelyard.operators.spark_models import fit_candidates, long_predictions, regressors
    df = _linear(spark, 300)
    models = fit_candidates(df, [VectorAssembler(inputCols=["x"], outputCol="features")],
                            regressors("y"), max_models=2)
    assert set(models) == {"linear", "glm"}
    m = regression_metrics(long_predictions(models, df, ["k"], "y")).collect()
    base = fit_closed_form(df, "y", [])
    mse_mean = measure_wide(df, base, "y").first()["mse"]
    for r in m:
        assert math.isfinite(r["mse"]) and r["mse"] < mse_mean


def test_long_measurement_matches_wide_for_many_models(spark):
    from modelyard.operators.closed_form import LinearModel, measure_long
    df = _linear(spark)
    ms = [LinearModel(f"m{i}", "least_squares", 1.0 + i, (("x", 0.1 * i),)) for i in range(12)]
    wide = {r["model_id"]: r for r in measure_wide(df, ms[:4], "y").collect()}
    long = {r["model_id"]: r for r in measure_long(df, ms[:4], "y").collect()}
    for mid in wide:
        for c in ["n", "mse", "mae", "rmsle", "r2"]:
            assert math.isclose(wide[mid][c], long[mid][c], rel_tol=1e-9)
    many = measure_wide(df, ms, "y").collect()      # delegates to the long form
    assert len(many) == 12
