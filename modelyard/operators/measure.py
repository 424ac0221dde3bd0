"""Model measurement: metrics per model (and fold), leaderboard, top-n.

Metric tables are tiny (one row per model or per model and fold), so the
windows that rank them run on aggregates, never on row data.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import (REGRESSION_METRICS, binary_grid, confusion_aggs,
                                 regression_aggs)
from ..functions.numeric import quote, round_sig_sql

# Metric registry (id, display name, greater is better, input).
METRIC_REGISTRY = [
    ("mse", "MSE", False, "prediction"),
    ("rmse", "RMSE", False, "prediction"),
    ("mae", "MAE", False, "prediction"),
    ("rmsle", "RMSLE", False, "prediction"),
    ("r2", "R2", True, "prediction"),
    ("mean_residual_deviance", "Mean Residual Deviance", False, "prediction"),
    ("accuracy", "Accuracy", True, "pred"),
    ("auc", "AUC", True, "pred_proba"),
    ("recall", "Recall", True, "pred"),
    ("precision", "Prec.", True, "pred"),
    ("f1", "F1", True, "pred"),
    ("kappa", "Kappa", True, "pred"),
    ("mcc", "MCC", True, "pred"),
    ("log_loss", "Log Loss", False, "pred_proba"),
]


def metric_registry(spark) -> DataFrame:
    """``get_metrics()`` as a static table."""
    return spark.createDataFrame(
        METRIC_REGISTRY, "id string, name string, greater_is_better boolean, input string")


def regression_metrics(pred: DataFrame, by: Sequence[str] = ("model_id",),
                       label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Long predictions -> one row per ``by`` group (partial + final agg)."""
    return pred.groupBy(*by).agg(*regression_aggs(label, prediction))


def rounded(df: DataFrame, cols: Sequence[str], digits: int = 9) -> DataFrame:
    """Round ``cols`` to ``digits`` significant digits (one SQL projection)."""
    keep = set(cols)
    return df.selectExpr(*[f"{round_sig_sql(quote(c), digits)} AS {quote(c)}" if c in keep
                           else quote(c) for c in df.columns])


def leaderboard(metrics: DataFrame, sort_metric: str = "rmse", ascending: bool | None = None,
                digits: int = 9) -> DataFrame:
    """Rank models best first; ties broken by ``model_id``.

    Metrics are rounded to ``digits`` significant digits before ranking so a
    change in summation order cannot reorder models.
    """
    if ascending is None:
        ascending = not {m[0]: m[2] for m in METRIC_REGISTRY}.get(sort_metric, False)
    num = [c for c, t in metrics.dtypes if t == "double"]
    r = rounded(metrics, num, digits)
    direction = "ASC" if ascending else "DESC"
    # Window over the per-model aggregate: one row per model.
    return r.selectExpr("*", f"row_number() OVER (ORDER BY {quote(sort_metric)} {direction} "
                             f"NULLS LAST, model_id) AS rank")


def best_n(board: DataFrame, n: int) -> DataFrame:
    """Top-n models of a leaderboard (``n_select`` / ``maxModels``)."""
    return board.where(F.col("rank") <= n)


def binary_metrics(pred: DataFrame, by: Sequence[str] = ("model_id",), label: str = "label",
                   prediction: str = "prediction", positive: int = 1) -> DataFrame:
    """Score grid columns from one confusion aggregate per group."""
    counts = pred.groupBy(*by).agg(*confusion_aggs(label, prediction, positive))
    return counts.select(*by, "tp", "fp", "fn", "tn", *binary_grid())


def confusion_matrix(pred: DataFrame, by: Sequence[str] = ("model_id",), label: str = "label",
                     prediction: str = "prediction") -> DataFrame:
    """Long confusion matrix: (by, label, prediction, n)."""
    return pred.groupBy(*by, label, prediction).agg(F.count(F.lit(1)).alias("n"))


def fold_summary(per_fold: DataFrame, metrics: Sequence[str] = tuple(REGRESSION_METRICS),
                 by: Sequence[str] = ("model_id",)) -> DataFrame:
    """Mean and population standard deviation of each metric over folds."""
    aggs = []
    for m in metrics:
        aggs += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_sd")]
    return per_fold.groupBy(*by).agg(F.count(F.lit(1)).alias("folds"), *aggs)


def current_metrics(sources: Mapping[str, DataFrame | None],
                    metrics: Sequence[str] = tuple(REGRESSION_METRICS)) -> DataFrame:
    """The metric that counts, per model: from the first source that has it.

    ``sources`` maps a name (cross-validation first, then validation, then
    training) to a wide metric frame, or to None where there is none.  Returns
    ``(model_id, metric, value, source, <one column per source>)``; a metric no
    source has keeps a null value and source.
    """
    long = None
    for name, frame in sources.items():
        if frame is None:
            continue
        part = (frame.select("model_id", *[F.col(m).cast("double").alias(m) for m in metrics])
                .unpivot(["model_id"], list(metrics), "metric", "value").withColumn("source", F.lit(name)))
        long = part if long is None else long.unionByName(part)
    if long is None:
        raise ValueError("no source of metrics")
    got = long.groupBy("model_id", "metric").agg(*[
        F.max(F.when(F.col("source") == n, F.col("value"))).alias(n) for n in sources])
    which = F.coalesce(*[F.when(F.col(n).isNotNull(), F.lit(n)) for n in sources])
    return got.select("model_id", "metric", F.coalesce(*[F.col(n) for n in sources]).alias("value"),
                      which.alias("source"), *sources)


def present_only(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows whose ``cols`` are all present (a model detail that may be absent).

    Optional per-model tables are empty frames rather than ``None``, so
    callers can always union and filter them.
    """
    cond = None
    for c in cols:
        x = F.col(c).isNotNull()
        cond = x if cond is None else cond & x
    return df.where(cond) if cond is not None else df
