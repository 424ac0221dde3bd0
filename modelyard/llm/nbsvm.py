"""Quality classifier: naive Bayes support vectors.

Indicators of token unigrams and bigrams, hashed to a fixed number of
features, are scaled by the log ratio of their class counts; a linear
hinge-loss model on the scaled indicators is fitted by dual coordinate descent.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import map_text
from .graph import written
from .tokens import TokenIds

FEATURE_BITS = 18
SAMPLE_ROWS = 12_000       # rows of the hinge-loss fit; class counts use every row
EPOCHS = 12
COST = 1.0
ALPHA = 1.0


def indicators(ids: np.ndarray, bits: int = FEATURE_BITS) -> np.ndarray:
    """Distinct hashed unigrams and bigrams of a token sequence, ascending."""
    if not len(ids):
        return np.empty(0, np.int32)
    a = ids.astype(np.uint64)
    uni = a * np.uint64(0x9E3779B97F4A7C15)
    two = (a[:-1] * np.uint64(0xC2B2AE3D27D4EB4F) + a[1:]) * np.uint64(0x9E3779B97F4A7C15)
    return np.unique((np.concatenate([uni, two]) >> np.uint64(64 - bits)).astype(np.int32))


def _features(rows: DataFrame) -> DataFrame:
    def make():
        tokens = TokenIds()

        def fn(texts):
            return [[indicators(tokens(t)) for t in texts]]
        return fn
    return map_text(rows, make, [T.StructField("features", T.ArrayType(T.IntegerType()))])


def log_ratios(train: DataFrame, bits: int = FEATURE_BITS, alpha: float = ALPHA) -> np.ndarray:
    """log of class-1 over class-0 indicator frequency, over all training rows."""
    counts = (train.select("label", F.explode("features").alias("f"))
              .groupBy("f").agg(F.sum("label").alias("pos"), F.count("*").alias("n")).toPandas())
    pos, neg = np.full(1 << bits, alpha), np.full(1 << bits, alpha)
    at = counts["f"].to_numpy(np.int64)
    pos[at] += counts["pos"].to_numpy(np.float64)
    neg[at] += counts["n"].to_numpy(np.float64) - counts["pos"].to_numpy(np.float64)
    return np.log(pos / pos.sum()) - np.log(neg / neg.sum())


def dual_descent(rows: list[np.ndarray], labels: np.ndarray, ratio: np.ndarray,
                 cost: float = COST, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights and bias of the L1-loss linear SVM, by dual coordinate descent.

    The bias is one more feature that always is 1.  The classes get equal
    total cost.
    """
    y = np.where(labels > 0, 1.0, -1.0)
    share = np.where(y > 0, max((y < 0).mean(), 1e-9), max((y > 0).mean(), 1e-9)) * 2
    w, bias = np.zeros(len(ratio)), 0.0
    xs = []
    for f in rows:
        x = ratio[f]
        xs.append(x / max(np.sqrt((x * x).sum()), 1e-12))
    q = np.array([(x * x).sum() + 1.0 for x in xs])
    dual, top = np.zeros(len(rows)), cost * share
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            f, x = rows[i], xs[i]
            grad = y[i] * (w[f] @ x + bias) - 1.0
            new = min(max(dual[i] - grad / q[i], 0.0), top[i])
            if new != dual[i]:
                step = (new - dual[i]) * y[i]
                w[f] += step * x
                bias += step
                dual[i] = new
    return w, bias


def _least_hashed(train: DataFrame, rows: int) -> DataFrame:
    """The ``rows`` rows with the least hash of the id, or all where there are fewer.

    Evenly spread hashes have that many rows below a bound, six standard
    deviations to spare; only where they are not (one id on many rows) does
    every partition offer its least ones.  The rows chosen are the same.
    """
    keyed = train.withColumn("h", F.xxhash64("doc_id"))
    share = (rows + 6 * math.sqrt(rows)) / max(train.count(), 1)
    if share < 1:
        below = keyed.where(F.col("h") < F.lit(int(share * 2.0 ** 64 - 2.0 ** 63)))
        if below.count() >= rows:
            keyed = below
    return keyed.orderBy("h", "doc_id", "label").limit(rows)


def fit(rows: DataFrame, sample_rows: int = SAMPLE_ROWS) -> tuple[np.ndarray, float, np.ndarray]:
    """(weights, bias, log ratios) from ``(doc_id, text, label)``.

    Class counts cover every row.  The hinge-loss fit takes the
    ``sample_rows`` rows with the least hash of the id, a bounded sample that
    one task holds.  Without rows all weights are 0.
    """
    train = written(_features(rows).select(
        "doc_id", "label", "features"), "nbsvm-train")
    ratio = log_ratios(train)
    sample = _least_hashed(train, sample_rows).select("label", "features", F.lit(0).alias("one"))
    shared = train.sparkSession.sparkContext.broadcast(ratio)

    def solve(pdf):
        import pandas as pd
        w, bias = dual_descent([np.asarray(f, dtype=np.int64) for f in pdf["features"]],
                               pdf["label"].to_numpy(), shared.value)
        return pd.DataFrame({"w": [w.astype(np.float64).tobytes()], "bias": [bias]})

    got = sample.groupBy("one").applyInPandas(solve, "w binary, bias double").collect()
    if not got:
        return np.zeros(len(ratio)), 0.0, ratio
    return np.frombuffer(got[0]["w"]), float(got[0]["bias"]), ratio


def predict(df: DataFrame, model: tuple, text_col: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1, higher: class 1 likelier) to every row.

    Null and empty texts have no indicators and get the score of the bias.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def make():
        w, bias, ratio = shared.value
        both = w * ratio
        tokens = TokenIds()

        def fn(texts):
            out = []
            for t in texts:
                f = indicators(tokens(t))
                x = ratio[f]
                size = max(float(np.sqrt((x * x).sum())), 1e-12)
                margin = float(both[f].sum()) / size + bias
                out.append(float(1.0 / (1.0 + np.exp(-np.clip(2.0 * margin, -60, 60)))))
            return [out]
        return fn

    return map_text(df, make, [T.StructField("score", T.DoubleType())], text_col)
