"""Metric expressions as Spark aggregate columns.

All metrics are written as aggregates over (label, prediction) so that many
models are measured in one pass with partial (map-side) aggregation.
Zero denominators give null (regression) or 0 (classification grid), never
an ANSI error.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import round_sig, round_sig_sql


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def regression_inputs(y: str | Column, p: str | Column, suffix: str = "") -> list[Column]:
    """Per-row inputs of the regression metrics, as columns to project first.

    ``_e``: error (null unless both sides present), ``_l``: log1p error,
    ``_m``: min(label, prediction) for the RMSLE domain check, ``_yv``: the
    label on rows that have a prediction.  Aggregating plain columns keeps
    the plan small when many models are measured at once.
    """
    y, p = _c(y), _c(p)
    valid = y.isNotNull() & p.isNotNull()
    s = suffix
    return [F.when(valid, y - p).alias(f"_e{s}"),
            F.when(valid & (F.least(y, p) > -1.0), F.log1p(y) - F.log1p(p)).alias(f"_l{s}"),
            F.when(valid, F.least(y, p)).alias(f"_m{s}"),
            F.when(valid, y).alias(f"_yv{s}")]


def regression_aggs_of_inputs(suffix: str = "", out_suffix: str | None = None) -> list[Column]:
    """n, mse, rmse, mae, rmsle, r2, mean_residual_deviance over projected inputs.

    RMSLE is null when any label or prediction is <= -1 (log1p undefined);
    R2 is null when the label is constant.  Gaussian deviance equals MSE.
    """
    s = suffix
    o = suffix if out_suffix is None else out_suffix
    e, l_, m, yv = F.col(f"_e{s}"), F.col(f"_l{s}"), F.col(f"_m{s}"), F.col(f"_yv{s}")
    mse = F.avg(e * e)
    var = F.var_pop(yv)
    return [
        F.count(e).alias(f"n{o}"),
        mse.alias(f"mse{o}"),
        F.sqrt(mse).alias(f"rmse{o}"),
        F.avg(F.abs(e)).alias(f"mae{o}"),
        F.when(F.min(m) > F.lit(-1.0), F.sqrt(F.avg(l_ * l_))).alias(f"rmsle{o}"),
        # The ratio is rounded to 12 digits first: for a model whose MSE
        # equals the label variance (the mean on its own rows) 1 - ratio
        # would otherwise be floating-point noise.
        (F.lit(1.0) - round_sig(F.try_divide(mse, F.when(var > 0, var)), 12)).alias(f"r2{o}"),
        mse.alias(f"mean_residual_deviance{o}"),
    ]


def regression_inputs_sql(y: str, p: str, suffix: str = "") -> list[str]:
    """SQL text of :func:`regression_inputs` (one ``selectExpr`` for all models)."""
    s = suffix
    valid = f"({y} IS NOT NULL AND {p} IS NOT NULL)"
    return [f"CASE WHEN {valid} THEN {y} - {p} END AS _e{s}",
            f"CASE WHEN {valid} AND least({y}, {p}) > -1.0D THEN log1p({y}) - log1p({p}) END AS _l{s}",
            f"CASE WHEN {valid} THEN least({y}, {p}) END AS _m{s}",
            f"CASE WHEN {valid} THEN {y} END AS _yv{s}"]


def regression_aggs_sql(suffix: str = "", out_suffix: str | None = None) -> list[str]:
    """SQL text of :func:`regression_aggs_of_inputs`."""
    s = suffix
    o = suffix if out_suffix is None else out_suffix
    mse = f"avg(_e{s} * _e{s})"
    var = f"var_pop(_yv{s})"
    ratio = f"try_divide({mse}, CASE WHEN {var} > 0 THEN {var} END)"
    return [f"count(_e{s}) AS n{o}", f"{mse} AS mse{o}", f"sqrt({mse}) AS rmse{o}",
            f"avg(abs(_e{s})) AS mae{o}",
            f"CASE WHEN min(_m{s}) > -1.0D THEN sqrt(avg(_l{s} * _l{s})) END AS rmsle{o}",
            f"1.0D - {round_sig_sql(ratio, 12)} AS r2{o}",
            f"{mse} AS mean_residual_deviance{o}"]


def regression_aggs(y: str | Column, p: str | Column, suffix: str = "") -> list[Column]:
    """Regression metrics as aggregates over (label, prediction) expressions.

    For many models at once, project ``regression_inputs`` first and
    aggregate with ``regression_aggs_of_inputs`` (see ``closed_form``).
    """
    y, p = _c(y), _c(p)
    valid = y.isNotNull() & p.isNotNull()
    err = F.when(valid, y - p)
    lerr = F.when(valid & (F.least(y, p) > -1.0), F.log1p(y) - F.log1p(p))
    mse = F.avg(err * err)
    yv = F.when(valid, y)
    var = F.var_pop(yv)
    s = suffix
    return [
        F.count(err).alias(f"n{s}"),
        mse.alias(f"mse{s}"),
        F.sqrt(mse).alias(f"rmse{s}"),
        F.avg(F.abs(err)).alias(f"mae{s}"),
        F.when(F.min(F.when(valid, F.least(y, p))) > F.lit(-1.0), F.sqrt(F.avg(lerr * lerr)))
        .alias(f"rmsle{s}"),
        (F.lit(1.0) - round_sig(F.try_divide(mse, F.when(var > 0, var)), 12)).alias(f"r2{s}"),
        mse.alias(f"mean_residual_deviance{s}"),
    ]


REGRESSION_METRICS = ["mse", "rmse", "mae", "rmsle", "r2", "mean_residual_deviance"]


def confusion_aggs(y: str | Column, p: str | Column, positive: int = 1) -> list[Column]:
    """tp, fp, fn, tn counts for a binary label and a hard prediction."""
    y, p = _c(y), _c(p)
    pos_y, pos_p = y == positive, p == positive
    return [
        F.count_if(pos_y & pos_p).alias("tp"),
        F.count_if(~pos_y & pos_p).alias("fp"),
        F.count_if(pos_y & ~pos_p).alias("fn"),
        F.count_if(~pos_y & ~pos_p).alias("tn"),
    ]


def _safe_div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, F.when(b != 0, b)), F.lit(0.0))


def binary_grid(tp: str = "tp", fp: str = "fp", fn: str = "fn", tn: str = "tn") -> list[Column]:
    """Accuracy, recall, precision, F1, kappa, MCC from confusion counts.

    Counts are cast to double first: products of counts overflow bigint at
    cluster scale.
    """
    TP, FP, FN, TN = (F.col(c).cast("double") for c in (tp, fp, fn, tn))
    n = TP + FP + FN + TN
    acc = _safe_div(TP + TN, n)
    rec = _safe_div(TP, TP + FN)
    prec = _safe_div(TP, TP + FP)
    f1 = _safe_div(2 * prec * rec, prec + rec)
    pe = _safe_div((TP + FP) * (TP + FN) + (FN + TN) * (FP + TN), n * n)
    kappa = _safe_div(acc - pe, 1 - pe)
    mcc = _safe_div(TP * TN - FP * FN,
                    F.sqrt((TP + FP) * (TP + FN) * (TN + FP) * (TN + FN)))
    return [acc.alias("accuracy"), rec.alias("recall"), prec.alias("precision"),
            f1.alias("f1"), kappa.alias("kappa"), mcc.alias("mcc")]


def accuracy_agg(y: str | Column, p: str | Column) -> Column:
    y, p = _c(y), _c(p)
    return F.avg((y == p).cast("int")).alias("accuracy")


def log_loss_agg(p_label: str | Column, eps: float = 1e-7) -> Column:
    """Sparse categorical cross-entropy from the probability of the true class."""
    return (-F.avg(F.ln(F.greatest(_c(p_label), F.lit(eps))))).alias("log_loss")
