"""Registered queries on array (tensor) columns of `embeddings`."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.arrays import (add_axis, array_sum, flatten, max_pool1d, relu, scale,
                                softmax)
from ..functions.numeric import round_sig, round_sig_sql, to_float32, to_int64
from ..registry import register
from ..sources.tables import load_table

R = round_sig_sql


def _sq(a):
    return F.aggregate(a, F.lit(0.0).cast("double"),
                       lambda acc, x: acc + x.cast("double") * x.cast("double"))


ARRAY_TABLE_SQL = f"""
SELECT vec_id, CAST(label AS BIGINT) AS label,
       CAST(len(embedding) AS INTEGER) AS n_values,
       {R('list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE)))', 6)} AS value_sum,
       {R('list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))', 6)}
         AS sq_norm
FROM embeddings
"""


@register("array_table", "S3 P5", ARRAY_TABLE_SQL)
def array_table(spark, sf_dir):
    """Labelled array rows with float32 elements and an int64 label."""
    e = load_table(spark, sf_dir, "embeddings")
    arr = F.transform("embedding", lambda x: to_float32(x))
    return e.select("vec_id", to_int64("label").alias("label"),
                    F.size(arr).alias("n_values"),
                    round_sig(array_sum(arr), 6).alias("value_sum"),
                    round_sig(_sq(arr), 6).alias("sq_norm"))


SCALE_AXIS_SQL = f"""
WITH s AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x / 255.0 AS FLOAT)) AS scaled
  FROM embeddings),
n AS (SELECT vec_id, list_transform(scaled, lambda x: [x]) AS nested FROM s)
SELECT vec_id,
       CAST(len(nested) AS INTEGER) AS outer_n,
       CAST(len(nested[1]) AS INTEGER) AS inner_n,
       CAST(len(flatten(nested)) AS INTEGER) AS flat_n,
       {R('list_sum(list_transform(flatten(nested), lambda x: CAST(x AS DOUBLE)))', 6)} AS flat_sum
FROM n
"""


@register("array_scale_axis_flatten", "P7 P8 P9", SCALE_AXIS_SQL)
def array_scale_axis_flatten(spark, sf_dir):
    """Scale by 1/255 (float32), add a trailing axis, flatten it back."""
    e = load_table(spark, sf_dir, "embeddings")
    nested = add_axis(scale("embedding", 255.0))
    flat = flatten(nested)
    return e.select("vec_id",
                    F.size(nested).alias("outer_n"),
                    F.size(F.element_at(nested, 1)).alias("inner_n"),
                    F.size(flat).alias("flat_n"),
                    round_sig(array_sum(flat), 6).alias("flat_sum"))


MAX_POOL_SQL = f"""
WITH p AS (
  SELECT vec_id, list_transform(range(0, len(embedding) // 2),
           lambda i: list_max(list_slice(embedding, 2 * i + 1, 2 * i + 2))) AS pooled
  FROM embeddings)
SELECT vec_id, CAST(len(pooled) AS INTEGER) AS pooled_n,
       {R('list_sum(list_transform(pooled, lambda x: CAST(x AS DOUBLE)))', 6)} AS pooled_sum,
       {R('CAST(list_max(pooled) AS DOUBLE)', 6)} AS pooled_max
FROM p
"""


@register("array_max_pool", "P10", MAX_POOL_SQL)
def array_max_pool(spark, sf_dir):
    """Max over consecutive pairs (pool size 2)."""
    e = load_table(spark, sf_dir, "embeddings")
    pooled = max_pool1d("embedding", 2)
    return e.select("vec_id", F.size(pooled).alias("pooled_n"),
                    round_sig(array_sum(pooled), 6).alias("pooled_sum"),
                    round_sig(F.array_max(pooled).cast("double"), 6).alias("pooled_max"))


RELU_SOFTMAX_SQL = f"""
WITH r AS (
  SELECT vec_id, list_transform(embedding, lambda x: greatest(CAST(x AS DOUBLE), 0.0)) AS rl,
         list_max(embedding) AS m, embedding
  FROM embeddings),
s AS (
  SELECT vec_id, rl,
         list_transform(embedding, lambda x: exp(CAST(x AS DOUBLE) - CAST(m AS DOUBLE))) AS ex
  FROM r)
SELECT vec_id,
       {R('list_sum(rl)', 6)} AS relu_sum,
       CAST(len(list_filter(rl, lambda x: x > 0)) AS INTEGER) AS n_active,
       {R('list_max(list_transform(ex, lambda x: x / list_sum(ex)))', 6)} AS softmax_max,
       {R('list_sum(list_transform(ex, lambda x: x / list_sum(ex)))', 6)} AS softmax_sum
FROM s
"""


@register("array_relu_softmax", "P11", RELU_SOFTMAX_SQL)
def array_relu_softmax(spark, sf_dir):
    """Rectify element-wise; softmax over each array."""
    e = load_table(spark, sf_dir, "embeddings")
    rl = relu("embedding")
    sm = softmax("embedding")
    return e.select("vec_id",
                    round_sig(array_sum(rl), 6).alias("relu_sum"),
                    F.size(F.filter(rl, lambda x: x > 0)).alias("n_active"),
                    round_sig(F.array_max(sm), 6).alias("softmax_max"),
                    round_sig(array_sum(sm), 6).alias("softmax_sum"))
