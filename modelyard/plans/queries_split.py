"""Registered queries: splits, folds, row order, batches and shards."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ids import key_hash_sql
from ..operators.batching import repeat_batches, shard, shuffled_index
from ..operators.split import (hash_split_col, hash_split_sql, kfold_col, kfold_sql,
                               random_split, stratified_holdout, stratified_kfold)
from ..registry import register
from ..sources.tables import load_table

# A unique key of lineitem made of integer columns only (so the
# hash input prints the same in every engine).
LI_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
_LI = ", ".join(LI_KEYS)


@register("random_split_counts", "R1")
def random_split_counts(spark, sf_dir):
    """Spark's seeded ``randomSplit([0.8, 0.2], 1)``: rows per split (rows-only check)."""
    li = load_table(spark, sf_dir, "lineitem").select(*LI_KEYS)
    parts = random_split(li, [0.8, 0.2], seed=1)
    out = None
    for i, p in enumerate(parts):
        agg = p.agg(F.count(F.lit(1)).alias("n")).withColumn("split", F.lit(i))
        out = agg if out is None else out.unionByName(agg)
    return out.select("split", "n")


HASH_SPLIT_SQL = f"""
SELECT {_LI}, {hash_split_sql(LI_KEYS, [0.8, 0.2], 1)} AS split FROM lineitem
"""


@register("hash_split_rows", "R2", HASH_SPLIT_SQL)
def hash_split_rows(spark, sf_dir):
    """80/20 split from the key hash: a projection, stable under repartitioning."""
    li = load_table(spark, sf_dir, "lineitem")
    return li.select(*LI_KEYS, hash_split_col(LI_KEYS, [0.8, 0.2], 1).alias("split"))


KFOLD_SQL = f"SELECT {_LI}, {kfold_sql(LI_KEYS, 5, 1)} AS fold FROM lineitem"


@register("kfold_rows", "R4", KFOLD_SQL)
def kfold_rows(spark, sf_dir):
    li = load_table(spark, sf_dir, "lineitem")
    return li.select(*LI_KEYS, kfold_col(LI_KEYS, 5, 1).alias("fold"))


_RANKED_LABELS = f"""
WITH r AS (
  SELECT doc_id, quality,
         row_number() OVER (PARTITION BY quality ORDER BY {key_hash_sql(['doc_id'], 1)}, doc_id) - 1
           AS rnk,
         count(*) OVER (PARTITION BY quality) AS n
  FROM labels)
"""

STRATIFIED_HOLDOUT_SQL = _RANKED_LABELS + """
SELECT doc_id, quality,
       CAST(CASE WHEN rnk < floor(n * 7000 / 10000) THEN 0 ELSE 1 END AS INTEGER) AS split
FROM r
"""


@register("stratified_holdout", "R3", STRATIFIED_HOLDOUT_SQL)
def stratified_holdout_q(spark, sf_dir):
    """70/30 hold-out, exact per class (labels.quality)."""
    lab = load_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return stratified_holdout(lab, "quality", ["doc_id"], train_share=0.7, seed=1)


STRATIFIED_KFOLD_SQL = _RANKED_LABELS + """
SELECT doc_id, quality, CAST(rnk % 5 AS INTEGER) AS fold FROM r
"""


@register("stratified_kfold", "R5", STRATIFIED_KFOLD_SQL)
def stratified_kfold_q(spark, sf_dir):
    lab = load_table(spark, sf_dir, "labels").select("doc_id", "quality")
    return stratified_kfold(lab, "quality", ["doc_id"], k=5, seed=1)


SHUFFLE_SQL = f"""
SELECT event_id, user_id,
       row_number() OVER (ORDER BY {key_hash_sql(['event_id'], 7)}, event_id) - 1 AS order_idx
FROM events
"""


@register("shuffle_order", "R6", SHUFFLE_SQL)
def shuffle_order(spark, sf_dir):
    """Repeatable full shuffle of events: each row's position."""
    ev = load_table(spark, sf_dir, "events").select("event_id", "user_id")
    return shuffled_index(ev, ["event_id"], seed=7)


def _batches_sql(budget_expr: str) -> str:
    return f"""
WITH idx AS (SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS i FROM embeddings),
nn AS (SELECT count(*) AS n FROM embeddings),
b AS (SELECT {budget_expr} AS budget FROM nn),
ep AS (SELECT unnest(range(0, CAST(ceil(budget / n) AS BIGINT))) AS epoch FROM nn, b),
rows AS (
  SELECT vec_id, label, CAST(epoch AS INTEGER) AS epoch, i + n * epoch AS p
  FROM idx, ep, nn, b WHERE i + n * epoch < budget)
"""


STEP_BUDGET_SQL = _batches_sql("5 * 64") + """
SELECT vec_id, label, epoch, p, CAST(p // 64 AS BIGINT) AS batch_id,
       CAST(p % 64 AS INTEGER) AS pos_in_batch
FROM rows
"""


@register("step_budget_batches", "R7 R8", STEP_BUDGET_SQL)
def step_budget_batches(spark, sf_dir):
    """Repeat, batch 64, stop after 1 epoch x 5 steps = 320 rows."""
    e = load_table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return repeat_batches(e, ["vec_id"], batch_size=64, steps=5)


EPOCH_BATCHES_SQL = _batches_sql("2 * n") + """
SELECT CAST(p // 64 AS BIGINT) AS batch_id, count(*) AS n_rows,
       CAST(sum(label) AS BIGINT) AS label_sum, min(p) AS first_p,
       CAST(count(DISTINCT epoch) AS BIGINT) AS n_epochs
FROM rows GROUP BY 1
"""


@register("epoch_batches", "R7", EPOCH_BATCHES_SQL)
def epoch_batches(spark, sf_dir):
    """Two full passes over the table in batches of 64 (batches span epoch ends)."""
    e = load_table(spark, sf_dir, "embeddings").select("vec_id", "label")
    b = repeat_batches(e, ["vec_id"], batch_size=64, epochs=2)
    return b.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("label").cast("bigint").alias("label_sum"),
        F.min("p").alias("first_p"), F.countDistinct("epoch").alias("n_epochs"))


SHARD_SQL = """
SELECT CAST((row_number() OVER (ORDER BY vec_id) - 1) % 4 AS INTEGER) AS shard, vec_id, label
FROM embeddings
"""


@register("row_shards", "R9", SHARD_SQL)
def row_shards(spark, sf_dir):
    """Rows dealt to 4 workers by index modulo 4."""
    e = load_table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return shard(e, ["vec_id"], 4).select("shard", "vec_id", "label")
