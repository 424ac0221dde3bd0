"""Closed-form candidate models: fitted by one aggregate, scored by a projection.

These are the exactly checkable members of the candidate list: the constant
mean and one least-squares line per feature.  All candidates are fitted in a
single ``agg`` pass (partial aggregation on every executor, one tiny row to
the driver), so fitting k features costs one scan, not k.

A fitted model is a small Python value (its coefficients); scoring turns it
back into a Column expression, so predictions are computed inside whole-stage
codegen and every model is scored in the same scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metrics import REGRESSION_METRICS, regression_aggs_sql, regression_inputs_sql
from ..functions.numeric import double_literal, quote


@dataclass(frozen=True)
class LinearModel:
    """``prediction = intercept + sum(coef_i * x_i)``; no features = constant."""

    model_id: str
    algo: str
    intercept: float
    coefficients: tuple[tuple[str, float], ...] = ()
    params: dict = field(default_factory=dict, compare=False, hash=False)

    def predict(self) -> Column:
        expr = F.lit(self.intercept if self.intercept is not None else None).cast("double")
        for name, coef in self.coefficients:
            c = F.lit(coef).cast("double") if coef is not None else F.lit(None).cast("double")
            expr = expr + c * F.col(name).cast("double")
        return expr

    def predict_sql(self) -> str:
        """Spark SQL text of :meth:`predict` (one parse instead of many calls)."""
        out = double_literal(self.intercept)
        for name, coef in self.coefficients:
            out += f" + {double_literal(coef)} * CAST({quote(name)} AS DOUBLE)"
        return out


def fit_closed_form(train: DataFrame, label: str, features: Sequence[str],
                    prefix: str = "") -> list[LinearModel]:
    """Fit the constant mean and one least-squares line per feature.

    One aggregate pass; the driver receives 1 + 2k numbers.  A feature that
    is constant on the train rows has no slope (null); its model then falls
    back to the mean.
    """
    y = F.col(label).cast("double")
    aggs = [F.avg(y).alias("_mean"), F.count(y).alias("_n")]
    for i, f in enumerate(features):
        x = F.col(f).cast("double")
        aggs += [F.regr_slope(y, x).alias(f"_b{i}"), F.regr_intercept(y, x).alias(f"_a{i}")]
    row = train.agg(*aggs).first()
    params_common = {"label": label, "train_rows": str(row["_n"])}
    models = [LinearModel(f"{prefix}mean", "constant_mean", row["_mean"], (),
                          {**params_common, "model_id": f"{prefix}mean"})]
    for i, f in enumerate(features):
        b, a = row[f"_b{i}"], row[f"_a{i}"]
        mid = f"{prefix}lsq_{f}"
        if b is None:
            models.append(LinearModel(mid, "least_squares", row["_mean"], (),
                                      {**params_common, "model_id": mid, "feature": f}))
        else:
            models.append(LinearModel(mid, "least_squares", a, ((f, b),),
                                      {**params_common, "model_id": mid, "feature": f}))
    return models


def score_long(df: DataFrame, models: Sequence[LinearModel], label: str,
               keys: Sequence[str]) -> DataFrame:
    """Score every row with every model: ``(keys, model_id, label, prediction)``.

    One generator per row (``inline`` of an array of structs), not a join:
    the model list is a literal inside the projection, written as SQL text.
    """
    structs = []
    for m in models:
        mid = m.model_id.replace("'", "''")
        structs.append(f"named_struct('model_id', '{mid}', 'prediction', {m.predict_sql()})")
    return df.selectExpr(*[quote(k) for k in keys], f"CAST({quote(label)} AS DOUBLE) AS label",
                         f"inline(array({', '.join(structs)}))")


def _per_model_rows(models: Sequence[LinearModel], extra: str = "") -> str:
    cols = ["n", *REGRESSION_METRICS]
    structs = []
    for i, m in enumerate(models):
        fields = ", ".join(f"'{c}', {c}__{i}" for c in cols)
        mid = m.model_id.replace("'", "''")
        structs.append(f"named_struct('model_id', '{mid}'{extra}, {fields})")
    return f"inline(array({', '.join(structs)}))"


# Above this many models the wide aggregate would exceed Spark's codegen field
# limit (spark.sql.codegen.maxFields, 100); the long form is used instead.
WIDE_MAX_MODELS = 8


def measure_long(df: DataFrame, models: Sequence[LinearModel], label: str) -> DataFrame:
    """Metrics per model from the long predictions: ``inline`` then ``groupBy``.

    The plan size does not grow with the number of models; partial
    aggregation keeps one row per model per task before the shuffle.
    """
    pred = score_long(df, models, label, [])
    inputs = pred.selectExpr("model_id", *regression_inputs_sql("label", "prediction", "_x"))
    aggs = [F.expr(a) for a in regression_aggs_sql("_x", "")]
    return inputs.groupBy("model_id").agg(*aggs)


def measure_wide(df: DataFrame, models: Sequence[LinearModel], label: str) -> DataFrame:
    """All regression metrics of all models in one aggregate, one row per model.

    With more than ``WIDE_MAX_MODELS`` models this delegates to
    :func:`measure_long`.

    Predictions and per-row errors are projected into columns first, so the
    aggregate refers to plain columns (a small plan, compiled once); the
    expressions are written as SQL text, one parse per step instead of
    thousands of driver round trips.  The aggregate has no grouping key:
    each task keeps one partial row and the final merge sees one row per
    task.  ``inline`` turns the wide row into one row per model.
    """
    if len(models) > WIDE_MAX_MODELS:
        return measure_long(df, models, label)
    scored = df.selectExpr(f"CAST({quote(label)} AS DOUBLE) AS _y",
                           *[f"{m.predict_sql()} AS _p{i}" for i, m in enumerate(models)])
    inputs = scored.selectExpr(*[c for i, _ in enumerate(models)
                                 for c in regression_inputs_sql("_y", f"_p{i}", f"_{i}")])
    wide = inputs.selectExpr(*[a for i, _ in enumerate(models)
                               for a in regression_aggs_sql(f"_{i}", f"__{i}")])
    return wide.selectExpr(_per_model_rows(models))


def models_frame(spark, models: Sequence[LinearModel], artifact_root: str | None = None) -> DataFrame:
    """Models table: id, algo, intercept, coefficient map, params map."""
    rows = [(m.model_id, m.algo, float(m.intercept) if m.intercept is not None else None,
             {k: float(v) for k, v in m.coefficients},
             {k: str(v) for k, v in m.params.items()}) for m in models]
    schema = ("model_id string, algo string, intercept double, "
              "coefficients map<string,double>, params map<string,string>")
    return spark.createDataFrame(rows, schema)


def _merge(a: tuple, b: tuple) -> tuple:
    """Pairwise merge of centred statistics (n, mean_x, mean_y, m2x, cxy)."""
    na, mxa, mya, m2a, ca = a
    nb, mxb, myb, m2b, cb = b
    n = na + nb
    if na == 0:
        return b
    if nb == 0:
        return a
    dx, dy = mxb - mxa, myb - mya
    return (n, mxa + dx * nb / n, mya + dy * nb / n,
            m2a + m2b + dx * dx * na * nb / n, ca + cb + dx * dy * na * nb / n)


def fit_fold_models(train: DataFrame, label: str, features: Sequence[str], fold_col: str,
                    k: int) -> dict[int, list[LinearModel]]:
    """Closed-form candidates fitted once per fold, each on the other k-1 folds.

    One ``groupBy(fold)`` pass collects centred sufficient statistics per
    fold (count, means, population variance and covariance: Spark's stable
    one-pass aggregates), k small rows.  The statistics of the other k-1
    folds are merged with the pairwise update of Chan et al., which equals
    a direct fit on those rows without generating any row twice.
    """
    y = F.col(label).cast("double")
    aggs = [F.count(y).alias("_ny"), F.avg(y).alias("_my")]
    for i, f in enumerate(features):
        x = F.col(f).cast("double")
        ok = x.isNotNull() & y.isNotNull()
        xv, yv = F.when(ok, x), F.when(ok, y)
        aggs += [F.count(xv).alias(f"_n{i}"), F.avg(xv).alias(f"_mx{i}"), F.avg(yv).alias(f"_my{i}"),
                 (F.var_pop(xv) * F.count(xv)).alias(f"_m2{i}"),
                 (F.covar_pop(xv, yv) * F.count(xv)).alias(f"_c{i}")]
    per = {int(r[fold_col]): r for r in train.groupBy(fold_col).agg(*aggs).collect()
           if r[fold_col] is not None}
    out: dict[int, list[LinearModel]] = {}
    for fold in range(k):
        others = [r for f, r in per.items() if f != fold]
        ny = sum(r["_ny"] for r in others)
        my = (sum(r["_ny"] * r["_my"] for r in others if r["_ny"]) / ny) if ny else None
        common = {"label": label, "train_rows": str(ny), "fold": str(fold)}
        ms = [LinearModel("mean", "constant_mean", my, (), {**common, "model_id": "mean"})]
        for i, f in enumerate(features):
            st = (0, 0.0, 0.0, 0.0, 0.0)
            for r in others:
                if r[f"_n{i}"]:
                    st = _merge(st, (r[f"_n{i}"], r[f"_mx{i}"], r[f"_my{i}"], r[f"_m2{i}"], r[f"_c{i}"]))
            n, mx, myx, m2, c = st
            mid = f"lsq_{f}"
            params = {**common, "model_id": mid, "feature": f}
            if n >= 2 and m2 > 0:
                b = c / m2
                ms.append(LinearModel(mid, "least_squares", myx - b * mx, ((f, b),), params))
            else:
                ms.append(LinearModel(mid, "least_squares", my, (), params))
        out[fold] = ms
    return out


def fold_coefficients(spark, fold_models: dict[int, list[LinearModel]]) -> DataFrame:
    """k-row table: fold, then intercept and slope of every candidate.

    The slope of a feature that a model doesn't use is null.
    """
    first = next(iter(fold_models.values()))
    feats = sorted({n for m in first for n, _ in m.coefficients} |
                   {f for ms in fold_models.values() for m in ms for f, _ in m.coefficients})
    rows, fields = [], ["fold int"]
    for i, _ in enumerate(first):
        fields.append(f"_a{i} double")
        fields += [f"_b{i}_{j} double" for j, _ in enumerate(feats)]
    for fold, ms in sorted(fold_models.items()):
        row = [fold]
        for m in ms:
            coefs = dict(m.coefficients)
            row.append(float(m.intercept) if m.intercept is not None else None)
            row += [float(coefs[f]) if f in coefs else None for f in feats]
        rows.append(tuple(row))
    return spark.createDataFrame(rows, ", ".join(fields)), feats


def measure_cv(train: DataFrame, fold_models: dict[int, list[LinearModel]], label: str,
               fold_col: str) -> DataFrame:
    """Regression metrics per (model_id, fold) on out-of-fold predictions.

    Each row is joined to the coefficients of the models that did not see
    its fold: a k-row table, broadcast (its size is k, known).  A model reads
    only its own features, so a null elsewhere doesn't cost it the row.  Predictions
    and errors are then projected and one grouped aggregate over the k folds
    measures every candidate at once.
    """
    from .broadcast import checked_broadcast
    first = next(iter(fold_models.values()))
    coef, feats = fold_coefficients(train.sparkSession, fold_models)
    j = train.join(checked_broadcast(coef, known_rows=len(fold_models)),
                   train[fold_col] == coef["fold"]).drop(coef["fold"])
    preds = []
    for i, _ in enumerate(first):
        own = {f for ms in fold_models.values() for f, _ in ms[i].coefficients}
        terms = [f"_a{i}"] + [
            f"CASE WHEN _b{i}_{jx} IS NULL THEN 0.0D ELSE _b{i}_{jx} * CAST({quote(f)} AS DOUBLE) END"
            for jx, f in enumerate(feats) if f in own]
        preds.append(f"{' + '.join(terms)} AS _p{i}")
    scored = j.selectExpr(quote(fold_col), f"CAST({quote(label)} AS DOUBLE) AS _y", *preds)
    inputs = scored.selectExpr(quote(fold_col), *[c for i, _ in enumerate(first)
                                                  for c in regression_inputs_sql("_y", f"_p{i}", f"_{i}")])
    aggs = [F.expr(a) for i, _ in enumerate(first) for a in regression_aggs_sql(f"_{i}", f"__{i}")]
    wide = inputs.groupBy(fold_col).agg(*aggs)
    return wide.selectExpr(_per_model_rows(first, extra=f", 'fold', {quote(fold_col)}"))


def coefficients_frame(train: DataFrame, models: Sequence[LinearModel]) -> DataFrame:
    """Coefficients with standardised values (coefficient x stddev of the feature).

    The standardised intercept is the prediction at the feature means.
    """
    feats = sorted({n for m in models for n, _ in m.coefficients})
    stats = train.agg(*[F.stddev_samp(F.col(f).cast("double")).alias(f"sd_{f}") for f in feats],
                      *[F.avg(F.col(f).cast("double")).alias(f"mu_{f}") for f in feats]).first() \
        if feats else {}
    rows = []
    for m in models:
        at_mean = m.intercept + sum(c * stats[f"mu_{n}"] for n, c in m.coefficients)
        rows.append((m.model_id, "Intercept", float(m.intercept), float(at_mean)))
        for n, c in m.coefficients:
            sd = stats[f"sd_{n}"]
            rows.append((m.model_id, n, float(c), float(c * sd) if sd is not None else None))
    spark = train.sparkSession
    return spark.createDataFrame(
        rows, "model_id string, name string, coefficient double, std_coefficient double")


def correlation_importance(train: DataFrame, label: str, features: Sequence[str]) -> DataFrame:
    """Relative importance = |corr(feature, label)|, scaled by the max and the sum.

    One aggregate over the rows, then windows over the k-row result.
    """
    from pyspark.sql import Window
    y = F.col(label).cast("double")
    wide = train.agg(*[F.abs(F.corr(F.col(f).cast("double"), y)).alias(f"c{i}")
                       for i, f in enumerate(features)])
    long = wide.select(F.inline(F.array(*[
        F.struct(F.lit(f).alias("variable"), F.col(f"c{i}").alias("relative_importance"))
        for i, f in enumerate(features)])))
    w = Window.partitionBy(F.lit(1))
    return long.select(
        "variable", "relative_importance",
        F.try_divide(F.col("relative_importance"), F.max("relative_importance").over(w))
        .alias("scaled_importance"),
        F.try_divide(F.col("relative_importance"), F.sum("relative_importance").over(w))
        .alias("percentage"))
