"""Train / hold-out splits and fold assignment.

Two families:

* ``random_split`` is Spark's own ``randomSplit``: seeded, but the split
  changes when the input is partitioned differently.
* ``hash_split`` / ``kfold`` derive the split from a seeded hash of the row
  key (integer arithmetic for integral keys, md5 otherwise).  They are plain projections (no shuffle), stable under any
  partitioning, and the same rows land in the same split in DuckDB.

Stratified variants either work on the rank of rows inside each class by the
key hash (the exact mode: class shares are met to the row), found by histograms
of the hash and not by sorting, or reuse the hash split, which is stratified in
expectation and needs no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ids import (hash_bucket_of, hash_bucket_of_sql, key_hash, key_hash_sql,
                             numeric_keys)
from .select import below_cut, bucketed_rank, class_cuts


def random_split(df: DataFrame, weights: Sequence[float], seed: int = 1) -> list[DataFrame]:
    """``df.randomSplit(weights, seed)``: weights are normalised."""
    return df.randomSplit(list(weights), seed)


def _cumulative(weights: Sequence[float]) -> list[float]:
    if not weights or any(w < 0 for w in weights) or sum(weights) <= 0:
        raise ValueError("weights must be non-negative with a positive sum")
    total = float(sum(weights))
    acc, out = 0.0, []
    for w in weights[:-1]:
        acc += w
        out.append(acc / total)
    return out


def hash_split_col(keys: Sequence[str | Column], weights: Sequence[float], seed: int = 1,
                   numeric: bool = True) -> Column:
    """Split index 0..len(weights)-1 from the key hash (normalised weights)."""
    return hash_bucket_of(key_hash(keys, seed, numeric), _cumulative(weights))


def hash_split_sql(keys: Sequence[str], weights: Sequence[float], seed: int = 1,
                   numeric: bool = True) -> str:
    return hash_bucket_of_sql(key_hash_sql(keys, seed, numeric), _cumulative(weights))


def hash_split(df: DataFrame, keys: Sequence[str], weights: Sequence[float],
               seed: int = 1) -> list[DataFrame]:
    """Disjoint frames covering ``df``, one per weight; no shuffle."""
    tagged = df.withColumn("_split", hash_split_col(keys, weights, seed, numeric_keys(df, keys)))
    return [tagged.where(F.col("_split") == i).drop("_split") for i in range(len(weights))]


def kfold_col(keys: Sequence[str | Column], k: int = 5, seed: int = 1,
              salt: str = "fold", numeric: bool = True) -> Column:
    """Fold 0..k-1 from a hash seeded apart from the train/hold-out split."""
    return hash_bucket_of(key_hash(keys, f"{seed}{salt}", numeric), [i / k for i in range(1, k)])


def kfold_sql(keys: Sequence[str], k: int = 5, seed: int = 1, salt: str = "fold",
              numeric: bool = True) -> str:
    return hash_bucket_of_sql(key_hash_sql(keys, f"{seed}{salt}", numeric),
                              [i / k for i in range(1, k)])


def class_rank(df: DataFrame, label: str, keys: Sequence[str], seed: int = 1,
               out: str = "class_rank", size: str = "class_n") -> DataFrame:
    """0-based rank of each row inside its class, ordered by (key hash, key).

    Rows are ranked inside (class, leading hash bits), a bucket of some ten
    thousand rows however large the class, and a histogram of the buckets gives
    the rows before each: one hash exchange, no range partitions.
    """
    return bucketed_rank(df, label, _order_hash(df, keys, seed), keys, out, size)


def _order_hash(df: DataFrame, keys: Sequence[str], seed: int) -> Column:
    """The key hash rows are ordered by; a null key comes first."""
    return F.coalesce(key_hash(keys, seed, numeric_keys(df, keys)), F.lit(0).cast("bigint"))


def stratified_holdout(df: DataFrame, label: str, keys: Sequence[str],
                       train_share: float = 0.7, seed: int = 1, mode: str = "exact",
                       out: str = "split") -> DataFrame:
    """``split`` 0 (train) or 1 (hold-out), stratified by ``label``.

    ``exact``: the first ``floor(n_class * train_share)`` rows of each class
    (in hash order) train.  The last of them is found by three histograms of
    the hash (:func:`~.select.class_cuts`), so the split itself is a projection.
    Rows equal in class and keys stay together.  ``hash``: the plain hash split.
    """
    if mode == "hash":
        return df.withColumn(out, hash_split_col(keys, [train_share, 1 - train_share], seed,
                                                 numeric_keys(df, keys)))
    bp = int(round(train_share * 10_000))
    h = _order_hash(df, keys, seed)
    return below_cut(df, class_cuts(df, label, h, keys, bp), label, h, keys, out)


def stratified_kfold(df: DataFrame, label: str, keys: Sequence[str], k: int = 5,
                     seed: int = 1, mode: str = "exact", out: str = "fold") -> DataFrame:
    """Fold per row; in ``exact`` mode folds of one class differ by <= 1 row."""
    if mode == "hash":
        return df.withColumn(out, kfold_col(keys, k, seed, numeric=numeric_keys(df, keys)))
    ranked = class_rank(df, label, keys, seed, out="_r", size="_n")
    return ranked.withColumn(out, F.pmod(F.col("_r"), F.lit(k)).cast("int")).drop("_r", "_n")
