"""Regression and classification metrics, ROC/AUC, leaderboard."""

import math

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from modelyard.functions.metrics import regression_aggs
from modelyard.functions.numeric import round_sig
from modelyard.operators.classify import auc_from_roc, roc_points
from modelyard.operators.measure import binary_metrics, confusion_matrix, leaderboard


def test_regression_metrics_match_numpy(spark):
    y = np.array([1.0, 2.0, 3.5, 4.0, 10.0])
    p = np.array([1.5, 1.0, 3.0, 5.0, 8.0])
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    r = df.agg(*regression_aggs("y", "p")).first()
    mse = np.mean((y - p) ** 2)
    assert r["n"] == 5
    assert math.isclose(r["mse"], mse)
    assert math.isclose(r["rmse"], math.sqrt(mse))
    assert math.isclose(r["mae"], np.mean(np.abs(y - p)))
    assert math.isclose(r["rmsle"], math.sqrt(np.mean((np.log1p(y) - np.log1p(p)) ** 2)))
    assert math.isclose(r["r2"], 1 - mse / np.var(y), rel_tol=1e-9)


def test_constant_label_r2_null_and_rmsle_guard(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, -1.5)], "y double, p double")
    r = df.agg(*regression_aggs("y", "p")).first()
    assert r["r2"] is None          # constant label: R2 undefined
    assert r["rmsle"] is None       # a prediction <= -1: log1p undefined


def test_null_predictions_ignored(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None), (3.0, 2.0)], "y double, p double")
    r = df.agg(*regression_aggs("y", "p")).first()
    assert r["n"] == 2
    assert math.isclose(r["mse"], 0.5)


def test_empty_holdout_gives_nulls(spark):
    df = spark.createDataFrame([], "y double, p double")
    r = df.agg(*regression_aggs("y", "p")).first()
    assert r["n"] == 0 and r["mse"] is None and r["r2"] is None


def test_binary_grid_zero_denominators(spark):
    # single class, nothing predicted positive: precision/recall/F1/MCC are 0, not errors
    df = spark.createDataFrame([("m", 0, 0)] * 5, "model_id string, label int, prediction int")
    g = binary_metrics(df).first()
    assert (g["tp"], g["fp"], g["fn"], g["tn"]) == (0, 0, 0, 5)
    assert g["accuracy"] == 1.0
    assert g["precision"] == 0.0 and g["recall"] == 0.0 and g["f1"] == 0.0
    assert g["mcc"] == 0.0 and g["kappa"] == 0.0


def test_binary_grid_values(spark):
    rows = [("m", 1, 1)] * 3 + [("m", 0, 1)] + [("m", 1, 0)] * 2 + [("m", 0, 0)] * 4
    g = binary_metrics(spark.createDataFrame(rows, "model_id string, label int, prediction int")).first()
    tp, fp, fn, tn = 3, 1, 2, 4
    assert math.isclose(g["precision"], tp / (tp + fp))
    assert math.isclose(g["recall"], tp / (tp + fn))
    mcc = (tp * tn - fp * fn) / math.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    assert math.isclose(g["mcc"], mcc)


def _rank_auc(y, s):
    r = pd.Series(s).rank().to_numpy()
    pos = np.array(y) == 1
    n1, n0 = pos.sum(), (~pos).sum()
    return (r[pos].sum() - n1 * (n1 + 1) / 2) / (n1 * n0)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 6)), min_size=4, max_size=60))
def test_auc_equals_rank_formula_with_ties(spark, pairs):
    ys = [p[0] for p in pairs]
    if len(set(ys)) < 2:
        return
    df = spark.createDataFrame([("m", y, float(s)) for y, s in pairs],
                               "model_id string, label int, score double")
    auc = auc_from_roc(roc_points(df)).first()["auc"]
    assert 0.0 <= auc <= 1.0
    assert math.isclose(auc, _rank_auc(ys, [p[1] for p in pairs]), rel_tol=1e-9)


def test_auc_invariant_under_monotone_map(spark):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 200)
    s = rng.normal(size=200) + y
    df = spark.createDataFrame(pd.DataFrame({"model_id": "m", "label": y, "score": s}))
    a1 = auc_from_roc(roc_points(df)).first()["auc"]
    a2 = auc_from_roc(roc_points(df.withColumn("score", F.exp("score") * 3 + 1))).first()["auc"]
    assert math.isclose(a1, a2)


def test_roc_ends_at_one(spark):
    df = spark.createDataFrame([("m", 1, 0.9), ("m", 0, 0.1), ("m", 1, 0.4), ("m", 0, 0.4)],
                               "model_id string, label int, score double")
    pts = roc_points(df).orderBy(F.col("score").desc()).collect()
    assert pts[-1]["tpr"] == 1.0 and pts[-1]["fpr"] == 1.0


def test_confusion_matrix(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 2), (2, 2)], "label int, prediction int")
    cm = {(r["label"], r["prediction"]): r["n"] for r in confusion_matrix(df, by=[]).collect()}
    assert cm == {(1, 1): 1, (1, 2): 1, (2, 2): 2}


def test_leaderboard_ties_broken_by_model_id(spark):
    m = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", 0.5)], "model_id string, rmse double")
    order = [r["model_id"] for r in leaderboard(m, "rmse").orderBy("rank").collect()]
    assert order == ["c", "a", "b"]


def test_round_sig(spark):
    df = spark.createDataFrame([(123456.789,), (0.000123456789,), (0.0,), (None,), (-2.5e-9,)], "x double")
    got = [r[0] for r in df.select(round_sig("x", 4)).collect()]
    assert got == [123500.0, 0.0001235, 0.0, None, -2.5e-9]


def test_category_rates_one_job_and_map_scoring(spark):
    from modelyard.operators.classify import fit_category_rates, score_category_map
    rows = [("en", 1)] * 6 + [("en", 0)] * 2 + [("fr", 0)] * 3 + [("fr", 1)] + [("de", 1)] * 2
    train = spark.createDataFrame(rows, "lang string, y int")
    fit = fit_category_rates(train, "y", "lang")
    assert fit["mode"] == 1 and fit["n"] == 14
    assert math.isclose(fit["overall"], 9 / 14)
    assert fit["rates"] == {"en": 0.75, "fr": 0.25, "de": 1.0}
    test = spark.createDataFrame([("en",), ("fr",), ("xx",), (None,)], "lang string")
    got = [(r["score"], r["prediction"]) for r in score_category_map(test, "lang", fit["rates"], fit["overall"]).collect()]
    assert got == [(0.75, 1), (0.25, 0), (9 / 14, 1), (9 / 14, 1)]   # unseen and null: overall rate


def test_problem_kind_counts_exactly(spark):
    from modelyard.operators.features import problem_kind
    df = spark.range(5000).select((F.col("id") % 7).cast("int").alias("c"), F.col("id").alias("big"))
    assert problem_kind(df, "c").first()["kind"] == "multinomial"
    r = problem_kind(df, "big").first()
    assert r["kind"] == "regression" and r["n_distinct"] == 5000


def test_current_metrics_take_the_first_source_that_has_them(spark):
    from modelyard.operators.measure import current_metrics
    schema = "model_id string, mse double, r2 double"
    train = spark.createDataFrame([("a", 1.0, 0.1), ("b", 2.0, None), ("c", 3.0, 0.3)], schema)
    valid = spark.createDataFrame([("a", 4.0, 0.4), ("b", None, 0.5)], schema)
    cv = spark.createDataFrame([("a", 6.0, None)], schema)
    got = {(r["model_id"], r["metric"]): (r["value"], r["source"]) for r in current_metrics(
        {"cv": cv, "validation": valid, "training": train}, ["mse", "r2"]).collect()}
    assert got == {("a", "mse"): (6.0, "cv"), ("a", "r2"): (0.4, "validation"), ("b", "mse"): (2.0, "training"),
                   ("b", "r2"): (0.5, "validation"), ("c", "mse"): (3.0, "training"), ("c", "r2"): (0.3, "training")}
    only = current_metrics({"validation": valid.where("model_id = 'b'"), "training": train.where("model_id = 'b'")},
                           ["r2"]).first()
    assert (only["value"], only["source"], only["training"]) == (0.5, "validation", None)
