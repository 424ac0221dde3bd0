"""Spark ML candidates: automatic search, classifier comparison, dense network.

Every fit is a distributed Spark ML job (tree aggregation over the rows);
candidates run concurrently from a small driver thread pool, which is how
Spark schedules several independent jobs on one cluster.  Predictions of all
candidates are unioned into one long frame and measured by one grouped
aggregate, as for the closed-form models.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def regressors(label: str, seed: int = 1) -> list[tuple[str, Callable]]:
    """The candidate list, in order; ``max_models`` keeps a prefix of it."""
    from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor,
                                       GeneralizedLinearRegression, LinearRegression,
                                       RandomForestRegressor)
    return [
        ("linear", lambda: LinearRegression(labelCol=label, maxIter=50)),
        ("glm", lambda: GeneralizedLinearRegression(labelCol=label, family="gaussian", maxIter=50)),
        ("tree", lambda: DecisionTreeRegressor(labelCol=label, seed=seed, maxDepth=5)),
        ("forest", lambda: RandomForestRegressor(labelCol=label, seed=seed, numTrees=20, maxDepth=5)),
        ("gbt", lambda: GBTRegressor(labelCol=label, seed=seed, maxIter=20, maxDepth=4)),
    ]


def iterative_regressors(label: str, seed: int = 1) -> list[tuple[str, Callable]]:
    """The candidates that are fitted step by step, so that they have a history."""
    from pyspark.ml.regression import LinearRegression
    return [("linear", lambda: LinearRegression(labelCol=label, maxIter=50, solver="l-bfgs")),
            *[c for c in regressors(label, seed) if c[0] == "gbt"]]


def classifiers(label: str, seed: int = 1) -> list[tuple[str, Callable]]:
    from pyspark.ml.classification import (DecisionTreeClassifier, GBTClassifier, LinearSVC,
                                           LogisticRegression, NaiveBayes,
                                           RandomForestClassifier)
    return [
        ("logistic", lambda: LogisticRegression(labelCol=label, maxIter=20)),
        ("naive_bayes", lambda: NaiveBayes(labelCol=label)),
        ("tree", lambda: DecisionTreeClassifier(labelCol=label, seed=seed, maxDepth=5)),
        ("forest", lambda: RandomForestClassifier(labelCol=label, seed=seed, numTrees=20, maxDepth=5)),
        ("gbt", lambda: GBTClassifier(labelCol=label, seed=seed, maxIter=10, maxDepth=4)),
        ("linear_svc", lambda: LinearSVC(labelCol=label, maxIter=20)),
    ]


def _fit_timed(pipeline, df):
    t0 = time.perf_counter()
    model = pipeline.fit(df)
    return model, time.perf_counter() - t0


def fit_candidates(train: DataFrame, stages: Sequence, candidates: Sequence[tuple[str, Callable]],
                   max_models: int | None = None, parallelism: int = 4) -> dict:
    """Fit ``Pipeline(stages + [candidate])`` for the first ``max_models`` candidates.

    Returns ``{model_id: (PipelineModel, train_seconds)}``.  The train frame
    is persisted once (memory and disk) because every candidate scans it.
    """
    from pyspark.ml import Pipeline
    chosen = list(candidates)[: max_models or len(candidates)]
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            futs = {mid: pool.submit(_fit_timed, Pipeline(stages=[*stages, make()]), train)
                    for mid, make in chosen}
            return {mid: f.result() for mid, f in futs.items()}
    finally:
        train.unpersist()


def fit_fold_candidates(data: DataFrame, stages: Sequence, candidates: Sequence[tuple[str, Callable]],
                        fold_col: str, k: int, parallelism: int = 8) -> dict:
    """Fit every candidate on every fold's train part.

    Feature stages are fitted once per fold on that fold's train rows (no
    statistic sees the held-out fold) and the featurized rows are persisted
    while the candidates of that fold are fitted concurrently.  Returns
    ``{(fold, model_id): (PipelineModel, train_seconds)}`` where each model
    holds the fold's feature stages followed by the candidate.
    """
    from pyspark.ml import Pipeline, PipelineModel
    prepared = {}
    for fold in range(k):
        train = data.where(F.col(fold_col) != fold)
        feats = Pipeline(stages=list(stages)).fit(train)
        prepared[fold] = (feats, feats.transform(train).persist(StorageLevel.MEMORY_AND_DISK))
    out: dict = {}
    try:
        with ThreadPoolExecutor(max_workers=max(1, parallelism)) as pool:
            futs = {(fold, mid): pool.submit(_fit_timed, make(), prepared[fold][1])
                    for fold in range(k) for mid, make in candidates}
            for (fold, mid), f in futs.items():
                model, secs = f.result()
                out[(fold, mid)] = (PipelineModel(stages=[*prepared[fold][0].stages, model]), secs)
    finally:
        for _, featurized in prepared.values():
            featurized.unpersist()
    return out


def long_predictions(models: dict, df: DataFrame, keys: Sequence[str], label: str,
                     extra: Sequence[str] = ()) -> DataFrame:
    """Union of every model's predictions: (keys, model_id, label, prediction, extra)."""
    out = None
    for mid, (model, _) in models.items():
        p = model.transform(df).select(*keys, F.lit(mid).alias("model_id"),
                                       F.col(label).cast("double").alias("label"),
                                       F.col("prediction").cast("double").alias("prediction"),
                                       *extra)
        out = p if out is None else out.unionByName(p)
    return out


def fold_scores(fitted: dict, df: DataFrame, fold_col: str, keys: Sequence[str],
                label: str) -> DataFrame:
    """Out-of-fold predictions of all classifiers: (keys, fold, model_id, label, prediction, score).

    ``score`` is the probability of class 1, or the margin of a model that gives none.
    """
    return _out_of_fold(fitted, df, fold_col, keys, label, scores=True)


def fold_predictions(fitted: dict, df: DataFrame, fold_col: str, keys: Sequence[str],
                     label: str) -> DataFrame:
    """Out-of-fold predictions of any models: (keys, fold, model_id, label, prediction)."""
    return _out_of_fold(fitted, df, fold_col, keys, label, scores=False)


def _out_of_fold(fitted: dict, df: DataFrame, fold_col: str, keys: Sequence[str], label: str,
                 scores: bool) -> DataFrame:
    """``fitted`` is what :func:`fit_fold_candidates` returns.

    The rows of a fold are read and prepared once; every model then adds columns
    of its own, and one row per model comes out.
    """
    from pyspark.ml.functions import vector_to_array
    out = None
    for fold in sorted({f for f, _ in fitted}):
        rows, parts = None, []
        for (f, mid), (model, _) in fitted.items():
            if f != fold:
                continue
            *prepare, last = model.stages
            if rows is None:
                rows = df.where(F.col(fold_col) == fold)
                for stage in prepare:
                    rows = stage.transform(rows)
            i = len(parts)
            last = last.copy()
            names = {"predictionCol": f"_p{i}", "rawPredictionCol": f"_r{i}", "probabilityCol": f"_q{i}"}
            for param, name in names.items():
                if last.hasParam(param):
                    last._set(**{param: name})  # noqa: SLF001
            rows = last.transform(rows)
            made = [F.lit(mid).alias("model_id"), F.col(f"_p{i}").cast("double").alias("prediction")]
            if scores:
                made.append(vector_to_array(f"_q{i}" if last.hasParam("probabilityCol") else f"_r{i}")[1]
                            .alias("score"))
            parts.append(F.struct(*made))
        long = rows.select(*keys, F.col(fold_col), F.col(label).cast("double").alias("label"),
                           F.inline(F.array(*parts)))
        out = long if out is None else out.unionByName(long)
    return out


def timings(spark, models: dict) -> DataFrame:
    """Train seconds per model (the ``TT (Sec)`` column)."""
    return spark.createDataFrame([(m, float(s)) for m, (_, s) in models.items()],
                                 "model_id string, train_seconds double")


def scoring_history(model_stage, holdout_features: DataFrame, label: str) -> list[tuple]:
    """Per-iteration metric when the model has one: GBT loss per tree on the
    hold-out, or the optimiser's objective history of a linear model."""
    rows = []
    if hasattr(model_stage, "evaluateEachIteration"):
        for i, v in enumerate(model_stage.evaluateEachIteration(holdout_features, "squared")):
            rows.append((i + 1, "holdout_squared_loss", float(v)))
    if hasattr(model_stage, "summary") and hasattr(model_stage, "hasSummary") and model_stage.hasSummary:
        hist = getattr(model_stage.summary, "objectiveHistory", None)
        for i, v in enumerate(hist or []):
            rows.append((i, "objective", float(v)))
    return rows


def model_details(models: dict, feature_names: Sequence[str]) -> list[tuple]:
    """Coefficients of linear models and importances of tree models, when present.

    Rows ``(model_id, kind, name, value)``; kinds are ``coefficient``,
    ``intercept`` and ``importance`` (relative, scaled and share of the sum
    are derived from ``importance`` by the caller).
    """
    rows = []
    for mid, (pm, _) in models.items():
        st = pm.stages[-1]
        if hasattr(st, "coefficients"):
            for n, c in zip(feature_names, st.coefficients.toArray()):
                rows.append((mid, "coefficient", n, float(c)))
            rows.append((mid, "intercept", "Intercept", float(st.intercept)))
        if hasattr(st, "featureImportances"):
            for n, v in zip(feature_names, st.featureImportances.toArray()):
                rows.append((mid, "importance", n, float(v)))
    return rows
