"""Importance and history of fitted models from predictions alone.

``permutation_importance`` works for any model: one feature at a time is taken
from another row, and the loss of accuracy is its importance.  The other row is
half the table away in the order of a key hash, a fixed-point-free shuffle that
a join on the row index makes once for all features.  ``staged_predictions``
gives the prediction of a boosted model after every tree.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import key_hash, numeric_keys
from .index import row_index
from .measure import regression_metrics


def shifted_features(df: DataFrame, features: Sequence[str], keys: Sequence[str], seed: int = 1) -> DataFrame:
    """Add ``mk_<feature>``: the values of the row half the table on, in key-hash order."""
    h = key_hash(keys, seed, numeric_keys(df, keys))
    ordered = row_index(df.withColumn("mk_hash", h), ["mk_hash", *keys], out="mk_idx").drop("mk_hash")
    n = df.count()
    other = ordered.select(F.pmod(F.col("mk_idx") + F.lit(n - n // 2), F.lit(max(n, 1))).alias("mk_to"),
                           *[F.col(f"`{f}`").alias(f"mk_{f}") for f in features])
    return ordered.join(other, F.col("mk_idx") == F.col("mk_to")).drop("mk_to", "mk_idx")


def permutation_importance(score: Callable[[DataFrame], DataFrame], df: DataFrame, features: Sequence[str],
                           label: str, keys: Sequence[str], metric: str = "mse", seed: int = 1) -> DataFrame:
    """``(variable, base, permuted, relative, scaled, percentage)``, most important first.

    ``score`` adds ``prediction`` to a frame.  ``relative`` is the rise of the
    metric (at least 0), ``scaled`` its share of the largest, ``percentage`` of
    the sum; both are null when no feature matters.
    """
    rows = shifted_features(df, features, keys, seed)
    plain = rows.select(df.columns)
    out = score(plain).select(F.lit("").alias("variable"), F.col(label).cast("double").alias("label"), "prediction")
    for f in features:
        moved = rows.withColumn(f, F.col(f"mk_{f}")).select(df.columns)
        out = out.unionByName(score(moved).select(
            F.lit(f).alias("variable"), F.col(label).cast("double").alias("label"), "prediction"))
    got = regression_metrics(out, ["variable"]).select("variable", F.col(metric).alias("value"))
    # One row per feature from here on.
    base = got.where("variable = ''").select(F.col("value").alias("base"))
    each = got.where("variable <> ''").join(F.broadcast(base)).select(
        "variable", "base", F.col("value").alias("permuted"),
        F.greatest(F.col("value") - F.col("base"), F.lit(0.0)).alias("relative"))
    top = each.agg(F.max("relative").alias("mk_max"), F.sum("relative").alias("mk_sum"))
    return (each.join(F.broadcast(top))
            .select("variable", "base", "permuted", "relative",
                    F.try_divide("relative", "mk_max").alias("scaled"),
                    F.try_divide("relative", "mk_sum").alias("percentage"))
            .orderBy(F.desc("relative"), "variable"))


def staged_predictions(model, features: DataFrame, keep: Sequence[str]) -> DataFrame:
    """``(keep, iteration, prediction)`` after every tree of a boosted regression model.

    Each tree adds a column in the same scan; the running sums of the weighted
    trees come out as one row per iteration.
    """
    rows, parts = features, []
    for i, (tree, weight) in enumerate(zip(model.trees, model.treeWeights)):
        one = tree.copy()
        one._set(predictionCol=f"mk_t{i}")  # noqa: SLF001 - as every setter does
        rows = one.transform(rows)
        part = F.col(f"mk_t{i}") * F.lit(float(weight))
        parts.append(parts[-1] + part if parts else part)
    return rows.select(*keep, F.posexplode(F.array(*parts)).alias("iteration", "prediction")).withColumn(
        "iteration", F.col("iteration") + 1)


def staged_metrics(model, features: DataFrame, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Every regression metric after every tree: ``(by, iteration, metrics)``."""
    staged = staged_predictions(model, features.withColumn("mk_label", F.col(label).cast("double")), [*by, "mk_label"])
    return regression_metrics(staged, [*by, "iteration"], label="mk_label")
