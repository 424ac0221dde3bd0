"""Classification candidates and curve metrics.

* Baselines: majority class and per-category positive rate, both fitted on
  train rows only.
* Nearest class mean on array features: class centroids by one grouped
  vector sum, scored by array operations on whole Arrow batches.
* ROC points and AUC: counts per distinct score first (this shrinks the data
  to the distinct scores), then running sums from the distributed prefix sum
  (no single-task window even for one model with many distinct scores).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .broadcast import checked_broadcast
from .index import running_sum
from ..session import written_table


def score_category_rate(df: DataFrame, rates: DataFrame, cat: str, fallback: float,
                        threshold: float = 0.5, max_levels: int = 1_000_000) -> DataFrame:
    """Score = positive rate of the row's category (unseen: ``fallback``).

    The rate table has one row per category; it is broadcast only after its
    row count is checked against ``max_levels``.
    """
    r = checked_broadcast(rates.select(cat, F.col("rate").alias("_rate")), max_levels)
    return (df.join(r, cat, "left")
            .withColumn("score", F.coalesce(F.col("_rate"), F.lit(float(fallback))))
            .withColumn("prediction", (F.col("score") >= F.lit(threshold)).cast("int"))
            .drop("_rate"))


def fit_category_rates(train: DataFrame, label: str, cat: str, positive=1,
                       max_cells: int = 100_000) -> dict:
    """Majority class, overall positive rate and per-category rates in one job.

    One ``groupBy(cat, label).count()`` (partial aggregation keeps it at
    categories x classes rows, checked before it is collected).
    """
    rows = (train.groupBy(cat, label).agg(F.count(F.lit(1)).alias("n"))
            .limit(max_cells + 1).collect())
    if len(rows) > max_cells:
        raise ValueError(f"more than {max_cells} (category, class) cells")
    by_class: dict = {}
    by_cat: dict = {}
    for r in rows:
        by_class[r[label]] = by_class.get(r[label], 0) + r["n"]
        tot, pos = by_cat.get(r[cat], (0, 0))
        by_cat[r[cat]] = (tot + r["n"], pos + (r["n"] if r[label] == positive else 0))
    n = sum(by_class.values())
    mode = min(by_class, key=lambda c: (-by_class[c], c)) if by_class else None
    overall = by_class.get(positive, 0) / n if n else None
    rates = {c: p / t for c, (t, p) in by_cat.items() if c is not None}
    return {"mode": mode, "overall": overall, "rates": rates, "n": n}


def fit_category_table(train: DataFrame, label: str, cat: str, positive=1) -> tuple:
    """``(majority class, overall positive rate, rates)`` with one pass over the rows.

    The (category, class) counts are written once and everything else is read
    from them; ``rates`` is a table ``(cat, rate)``, so categories have no bound.
    """
    cells = written_table(train.groupBy(cat, label).agg(F.count(F.lit(1)).alias("n")), "category-counts")
    hit = F.when(F.col(label) == positive, F.col("n")).otherwise(F.lit(0))
    classes = cells.where(F.col(label).isNotNull()).groupBy(label).agg(F.sum("n").alias("n"))
    top = classes.agg(F.min_by(label, F.struct(-F.col("n"), F.col(label))).alias("mode")).first()
    overall = cells.agg((F.sum(hit) / F.sum("n")).alias("rate")).first()["rate"]
    rates = cells.where(F.col(cat).isNotNull()).groupBy(cat).agg((F.sum(hit) / F.sum("n")).alias("rate"))
    return top["mode"], overall, rates


def score_category_map(df: DataFrame, cat: str, rates: dict, fallback: float,
                       threshold: float = 0.5) -> DataFrame:
    """Score = the category's positive rate, looked up in a literal map (no join)."""
    if rates:
        m = F.create_map(*[x for k, v in sorted(rates.items())
                           for x in (F.lit(k), F.lit(float(v)))])
        looked = F.try_element_at(m, F.col(cat))
    else:
        looked = F.lit(None).cast("double")
    score = F.coalesce(looked, F.lit(float(fallback)))
    return (df.withColumn("score", score)
            .withColumn("prediction", (F.col("score") >= F.lit(threshold)).cast("int")))


def roc_counts(pred: DataFrame, label: str = "label", score: str = "score",
               by: Sequence[str] = ("model_id",), positive=1) -> DataFrame:
    """Positives and negatives per (by, distinct score)."""
    return pred.groupBy(*by, score).agg(
        F.count_if(F.col(label) == positive).alias("pos"),
        F.count_if(F.col(label) != positive).alias("neg"))


def roc_points(pred: DataFrame, label: str = "label", score: str = "score",
               by: Sequence[str] = ("model_id",), positive=1) -> DataFrame:
    """One ROC point per distinct score, highest score first (E5).

    ``tpr``/``fpr`` are the rates when predicting positive for every row
    with a score >= this one.
    """
    by = list(by)
    if not by:
        raise ValueError("roc_points needs at least one grouping column (e.g. model_id)")
    counts = roc_counts(pred, label, score, by, positive)
    cum = running_sum(counts, ["pos", "neg"], [F.col(score).desc()], group_cols=by)
    # The totals are the last running sums, read from the rows already written.
    totals = cum.groupBy(*by).agg(F.max("cum_pos").alias("P"), F.max("cum_neg").alias("N"))
    out = cum.join(checked_broadcast(totals), by)
    return out.select(
        *by, score, "pos", "neg", "cum_pos", "cum_neg",
        F.try_divide(F.col("cum_pos").cast("double"), F.col("P")).alias("tpr"),
        F.try_divide(F.col("cum_neg").cast("double"), F.col("N")).alias("fpr"),
        "P", "N")


def auc_from_roc(roc: DataFrame, by: Sequence[str] = ("model_id",)) -> DataFrame:
    """Area under the ROC curve, ties counted half.

    Trapezoid sum in closed form: each negative at a score scores the
    positives strictly above it plus half of those at the same score.
    """
    area = F.sum(F.col("neg").cast("double") *
                 (F.col("cum_pos") - F.col("pos") + F.col("pos") / F.lit(2.0)))
    return roc.groupBy(*by).agg(
        F.try_divide(area, F.first("P").cast("double") * F.first("N").cast("double")).alias("auc"))


def fit_centroids(df: DataFrame, vec: str, label: str,
                  max_cells: int = 10_000_000) -> list[tuple[object, list[float]]]:
    """Mean vector per class.

    Spark ML's summarizer adds up whole vectors, one partial sum per class and
    task, so a hot class is reduced where its rows are.  The result (classes x
    dim numbers) is checked before it is collected.  Null vectors are left out.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer
    rows = df.where(F.col(vec).isNotNull() & F.col(label).isNotNull()).select(label, array_to_vector(vec).alias("mk_v"))
    means = rows.groupBy(label).agg(vector_to_array(Summarizer.mean(F.col("mk_v"))).alias("mk_mean"))
    first = means.limit(1).collect()
    limit = max_cells // max(1, len(first[0]["mk_mean"]) if first else 1)
    got = means.limit(limit + 1).collect()
    if len(got) > limit:
        raise ValueError(f"more than {max_cells} centroid cells")
    return sorted(((r[label], list(r["mk_mean"])) for r in got), key=lambda c: c[0])


def predict_centroids(df: DataFrame, vec: str, centroids, out: str = "prediction") -> DataFrame:
    """Nearest centroid label (ties: smallest label) and class probabilities.

    Probabilities are the softmax of minus the squared distances.  Distances of
    a whole Arrow batch are one array operation per class; the centroids go with
    the task, bounded where they are fitted.  A null vector gets nulls.
    """
    import numpy as np
    import pyarrow as pa
    centres = np.array([c for _, c in centroids])
    labels = F.array(*[F.lit(lbl) for lbl, _ in centroids])
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)

    def run(batches):
        for b in batches:
            x = b.column(vec)
            known = x.is_valid().to_numpy(zero_copy_only=False)
            rows = x.filter(x.is_valid()).flatten().to_numpy(zero_copy_only=False).astype(float)
            rows = rows.reshape(-1, centres.shape[1])
            d = np.stack([((rows - c) ** 2).sum(axis=1) for c in centres], axis=1)
            e = np.exp(d.min(axis=1, keepdims=True) - d)
            best = np.zeros(len(known), np.int32)
            best[known] = d.argmin(axis=1)
            probs = iter((e / e.sum(axis=1, keepdims=True)).tolist())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(best, pa.int32(), mask=~known),
                 pa.array([next(probs) if k else None for k in known], pa.list_(pa.float64()))],
                names=[*b.schema.names, "mk_best", "probability"])

    scored = df.mapInArrow(run, f"{fields}, mk_best int, probability array<double>")
    return scored.withColumn(out, F.try_element_at(labels, F.col("mk_best") + 1)).drop("mk_best")


def true_class_probability(label: str, centroids, probs: str = "probability") -> Column:
    labels = F.array(*[F.lit(lbl) for lbl, _ in centroids])
    return F.try_element_at(F.col(probs), F.array_position(labels, F.col(label)).cast("int"))
