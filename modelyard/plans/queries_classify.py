"""Registered queries: classification baselines, score grid, ROC/AUC, centroids."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ids import key_hash_sql
from ..functions.metrics import accuracy_agg, log_loss_agg
from ..functions.numeric import round_sig, round_sig_sql
from ..operators.classify import (auc_from_roc, fit_category_table, fit_centroids,
                                  predict_centroids, roc_points, score_category_rate,
                                  true_class_probability)
from ..operators.measure import binary_metrics, confusion_matrix, rounded
from ..operators.split import stratified_holdout
from ..registry import register
from ..sources.tables import load_table

R = round_sig_sql


def labelled_docs(spark, sf_dir):
    """labels joined to documents on doc_id; only the needed columns are read."""
    lab = load_table(spark, sf_dir, "labels").select("doc_id", "quality")
    docs = load_table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return lab.join(docs, "doc_id")


def class_split(spark, sf_dir):
    """Stratified 70/30 hold-out of the labelled documents (exact per class)."""
    d = stratified_holdout(labelled_docs(spark, sf_dir), "quality", ["doc_id"], 0.7, seed=1)
    train = d.where(F.col("split") == 0).drop("split")
    hold = d.where(F.col("split") == 1).drop("split")
    return train, hold


def baseline_predictions(spark, sf_dir):
    """Hold-out predictions of the majority-class and per-language-rate models."""
    train, hold = class_split(spark, sf_dir)
    mode, overall, rates = fit_category_table(train, "quality", "lang")
    maj = hold.select("doc_id", F.col("quality").alias("label"),
                      F.lit("majority").alias("model_id"),
                      F.lit(float(mode == 1)).alias("score"),
                      F.lit(int(mode)).alias("prediction"))
    lr = score_category_rate(hold, rates, "lang", overall).select(
        "doc_id", F.col("quality").alias("label"), F.lit("lang_rate").alias("model_id"),
        "score", "prediction")
    return maj.unionByName(lr)


_SPLIT_CTE = f"""
ld AS (SELECT l.doc_id, l.quality, d.lang, d.n_chars
       FROM labels l JOIN documents d ON l.doc_id = d.doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY {key_hash_sql(['doc_id'], 1)}, doc_id) - 1 AS rnk,
             count(*) OVER (PARTITION BY quality) AS n FROM ld),
s AS (SELECT *, CASE WHEN rnk < floor(n * 7000 / 10000) THEN 0 ELSE 1 END AS split FROM r),
train AS (SELECT * FROM s WHERE split = 0),
hold AS (SELECT * FROM s WHERE split = 1),
mode AS (SELECT quality AS m FROM train GROUP BY quality ORDER BY count(*) DESC, quality LIMIT 1),
overall AS (SELECT avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END) AS o FROM train),
rates AS (SELECT lang, avg(CASE WHEN quality = 1 THEN 1.0 ELSE 0.0 END) AS rate FROM train GROUP BY lang),
pred AS (
  SELECT doc_id, quality AS label, 'majority' AS model_id,
         CASE WHEN m = 1 THEN 1.0 ELSE 0.0 END AS score, m AS prediction FROM hold, mode
  UNION ALL
  SELECT h.doc_id, h.quality, 'lang_rate', coalesce(rates.rate, o),
         CASE WHEN coalesce(rates.rate, o) >= 0.5 THEN 1 ELSE 0 END
  FROM hold h LEFT JOIN rates ON h.lang = rates.lang, overall)
"""

CLASS_GRID_SQL = f"""
WITH {_SPLIT_CTE},
c AS (SELECT model_id,
             CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp,
             CAST(count_if(label <> 1 AND prediction = 1) AS BIGINT) AS fp,
             CAST(count_if(label = 1 AND prediction <> 1) AS BIGINT) AS fn,
             CAST(count_if(label <> 1 AND prediction <> 1) AS BIGINT) AS tn
      FROM pred GROUP BY model_id),
d AS (SELECT model_id, tp, fp, fn, tn, CAST(tp AS DOUBLE) AS TP, CAST(fp AS DOUBLE) AS FP,
             CAST(fn AS DOUBLE) AS FN, CAST(tn AS DOUBLE) AS TN FROM c),
g AS (SELECT *, CASE WHEN TP+FP+FN+TN = 0 THEN 0 ELSE (TP+TN)/(TP+FP+FN+TN) END AS acc,
             CASE WHEN TP+FN = 0 THEN 0 ELSE TP/(TP+FN) END AS rec,
             CASE WHEN TP+FP = 0 THEN 0 ELSE TP/(TP+FP) END AS prec,
             CASE WHEN TP+FP+FN+TN = 0 THEN 0 ELSE ((TP+FP)*(TP+FN) + (FN+TN)*(FP+TN)) / ((TP+FP+FN+TN)*(TP+FP+FN+TN)) END AS pe
      FROM d)
SELECT model_id, tp, fp, fn, tn,
       {R('acc')} AS accuracy, {R('rec')} AS recall, {R('prec')} AS precision,
       {R('CASE WHEN prec + rec = 0 THEN 0 ELSE 2 * prec * rec / (prec + rec) END')} AS f1,
       {R('CASE WHEN 1 - pe = 0 THEN 0 ELSE (acc - pe) / (1 - pe) END')} AS kappa,
       {R('CASE WHEN sqrt((TP+FP)*(TP+FN)*(TN+FP)*(TN+FN)) = 0 THEN 0 ELSE (TP*TN - FP*FN) / sqrt((TP+FP)*(TP+FN)*(TN+FP)*(TN+FN)) END')} AS mcc
FROM g
"""


@register("class_score_grid", "M4 E3 R3", CLASS_GRID_SQL)
def class_score_grid(spark, sf_dir):
    """Majority-class and per-language-rate models: hold-out score grid."""
    grid = binary_metrics(baseline_predictions(spark, sf_dir))
    return rounded(grid, ["accuracy", "recall", "precision", "f1", "kappa", "mcc"])


def roc_inputs(spark, sf_dir):
    """n_chars as a raw score on all labelled docs, plus the lang-rate model."""
    ld = labelled_docs(spark, sf_dir)
    raw = ld.select(F.lit("n_chars").alias("model_id"), F.col("quality").alias("label"),
                    F.col("n_chars").cast("double").alias("score"))
    lr = baseline_predictions(spark, sf_dir).where(F.col("model_id") == "lang_rate").select(
        "model_id", "label", "score")
    return raw.unionByName(lr)


_ROC_CTE = f"""
WITH {_SPLIT_CTE},
inp AS (
  SELECT 'n_chars' AS model_id, quality AS label, CAST(n_chars AS DOUBLE) AS score FROM ld
  UNION ALL SELECT model_id, label, score FROM pred WHERE model_id = 'lang_rate'),
cnt AS (SELECT model_id, score, CAST(count_if(label = 1) AS BIGINT) AS pos,
               CAST(count_if(label <> 1) AS BIGINT) AS neg
        FROM inp GROUP BY model_id, score),
roc AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
               sum(pos) OVER (PARTITION BY model_id) AS P, sum(neg) OVER (PARTITION BY model_id) AS N
        FROM cnt WINDOW w AS (PARTITION BY model_id ORDER BY score DESC
                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
"""

ROC_SQL = _ROC_CTE + f"""
SELECT model_id, score, pos, neg, CAST(cum_pos AS BIGINT) AS cum_pos, CAST(cum_neg AS BIGINT) AS cum_neg,
       {R('CAST(cum_pos AS DOUBLE) / P')} AS tpr, {R('CAST(cum_neg AS DOUBLE) / N')} AS fpr
FROM roc
"""


@register("roc_points", "E5", ROC_SQL)
def roc_points_q(spark, sf_dir):
    roc = roc_points(roc_inputs(spark, sf_dir), "label", "score", ["model_id"])
    return rounded(roc.drop("P", "N"), ["tpr", "fpr"])


AUC_SQL = _ROC_CTE + f"""
SELECT model_id,
       {R('sum(CAST(neg AS DOUBLE) * (cum_pos - pos + pos / 2.0)) / (CAST(max(P) AS DOUBLE) * max(N))')} AS auc
FROM roc GROUP BY model_id
"""


@register("auc", "E6", AUC_SQL)
def auc_q(spark, sf_dir):
    roc = roc_points(roc_inputs(spark, sf_dir), "label", "score", ["model_id"])
    return rounded(auc_from_roc(roc), ["auc"])


# Nearest class mean on embeddings (M6) and its measurements.

def centroid_predictions(spark, sf_dir):
    e = load_table(spark, sf_dir, "embeddings")
    cents = fit_centroids(e, "embedding", "label")
    pred = predict_centroids(e, "embedding", cents)
    return pred.withColumn("p_true", true_class_probability("label", cents)), cents


_CENTROID_CTE = """
WITH cells AS (
  SELECT label AS c, i, avg(CAST(embedding[i] AS DOUBLE)) AS v
  FROM embeddings, range(1, 65) t(i) GROUP BY label, i),
pairs AS (
  SELECT e.vec_id, e.label, c.c, sum((CAST(e.embedding[c.i] AS DOUBLE) - c.v) * (CAST(e.embedding[c.i] AS DOUBLE) - c.v)) AS d
  FROM embeddings e JOIN cells c ON c.i <= len(e.embedding) GROUP BY e.vec_id, e.label, c.c),
best AS (SELECT vec_id, label, arg_min(c, (d, c)) AS prediction, min(d) AS dmin FROM pairs GROUP BY vec_id, label),
probs AS (SELECT p.vec_id, p.label, exp(-p.d + b.dmin) / sum(exp(-p.d + b.dmin)) OVER (PARTITION BY p.vec_id) AS pr, p.c
          FROM pairs p JOIN best b ON p.vec_id = b.vec_id)
"""

CENTROID_SQL = _CENTROID_CTE + f"""
SELECT 'nearest_mean' AS model_id, count(*) AS n,
       {R('avg(CASE WHEN b.label = b.prediction THEN 1.0 ELSE 0.0 END)')} AS accuracy,
       {R('-avg(ln(greatest(p.pr, 1e-7)))')} AS log_loss
FROM best b JOIN probs p ON b.vec_id = p.vec_id AND p.c = b.label
"""


@register("nearest_class_mean", "M6 E2 E7 P11", CENTROID_SQL)
def nearest_class_mean(spark, sf_dir):
    """Nearest-centroid classifier on the 64-value arrays: accuracy and log loss."""
    pred, _ = centroid_predictions(spark, sf_dir)
    out = pred.agg(F.count(F.lit(1)).alias("n"),
                   accuracy_agg("label", "prediction"), log_loss_agg("p_true"))
    return out.select(F.lit("nearest_mean").alias("model_id"), "n",
                      round_sig("accuracy").alias("accuracy"), round_sig("log_loss").alias("log_loss"))


CONFUSION_SQL = _CENTROID_CTE + """
SELECT label, prediction, count(*) AS n FROM best GROUP BY label, prediction
"""


@register("confusion_matrix", "E4", CONFUSION_SQL)
def confusion_matrix_q(spark, sf_dir):
    pred, _ = centroid_predictions(spark, sf_dir)
    return confusion_matrix(pred, by=[], label="label", prediction="prediction")
