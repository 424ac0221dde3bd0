"""ROC and AUC from mergeable histograms of scores.

A sketch has one row per (model, score bin) with the positives and negatives in
it.  Bins have a fixed width, so sketches of different days or partitions add
up, and a stored sketch gains today's rows without yesterday's being read.  The
only exchange over rows is that of their bins, pre-aggregated on every task; the
running sums are taken over bins.

Scores inside one bin count as ties.  That moves the AUC by at most half the
share of (positive, negative) pairs that meet in a bin, which the sketch knows:
``auc_bound``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Fits probabilities; a power of two, so that bins are exact.
DEFAULT_WIDTH = 2.0 ** -12


def score_sketch(pred: DataFrame, width: float = DEFAULT_WIDTH, by: Sequence[str] = ("model_id",),
                 label: str = "label", score: str = "score", positive=1) -> DataFrame:
    """``(by, bin, pos, neg)`` with bin ``floor(score / width)``; rows without label or score are left out."""
    if width <= 0:
        raise ValueError("width must be positive")
    rows = pred.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    return rows.groupBy(*by, F.floor(F.col(score).cast("double") / F.lit(float(width))).cast("bigint").alias("bin")).agg(
        F.count_if(F.col(label) == positive).alias("pos"), F.count_if(F.col(label) != positive).alias("neg"))


def merge_sketches(sketches: Sequence[DataFrame], by: Sequence[str] = ("model_id",)) -> DataFrame:
    """The sketch of all rows from sketches of parts of them (of one width)."""
    whole = reduce(DataFrame.unionByName, sketches)
    return whole.groupBy(*by, "bin").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))


def sketch_roc(sketch: DataFrame, width: float = DEFAULT_WIDTH, by: Sequence[str] = ("model_id",)) -> DataFrame:
    """One ROC point per bin, highest first; ``score`` is the bin's lower edge.

    The window runs over the bins of a model, whose number the width sets.
    """
    down = Window.partitionBy(*by).orderBy(F.col("bin").desc()).rowsBetween(Window.unboundedPreceding, 0)
    whole = Window.partitionBy(*by)
    out = sketch.select(
        *by, "bin", (F.col("bin") * F.lit(float(width))).alias("score"), "pos", "neg",
        F.sum("pos").over(down).alias("cum_pos"), F.sum("neg").over(down).alias("cum_neg"),
        F.sum("pos").over(whole).alias("P"), F.sum("neg").over(whole).alias("N"))
    return out.withColumns({"tpr": F.try_divide(F.col("cum_pos").cast("double"), F.col("P")),
                            "fpr": F.try_divide(F.col("cum_neg").cast("double"), F.col("N"))})


def sketch_auc(sketch: DataFrame, by: Sequence[str] = ("model_id",)) -> DataFrame:
    """``auc`` (ties half) and ``auc_bound``, how far the exact one can be off; null for one class."""
    roc = sketch_roc(sketch, by=by)
    pairs = F.first("P").cast("double") * F.first("N").cast("double")
    above = F.sum(F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") + F.col("pos") / F.lit(2.0)))
    met = F.sum(F.col("neg").cast("double") * F.col("pos") / F.lit(2.0))
    return roc.groupBy(*by).agg(
        F.count(F.lit(1)).alias("bins"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"),
        F.try_divide(above, pairs).alias("auc"), F.try_divide(met, pairs).alias("auc_bound"))
