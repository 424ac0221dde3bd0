"""Row order, endless batches, step budgets and worker shards.

All build on the distributed row index (``operators.index.row_index``): no
unpartitioned window, no driver-side loop over rows.  Repetition is a
bounded ``explode(sequence(0, K-1))`` where K is derived from the budget, so
the budget is applied before rows are multiplied.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.ids import key_hash, numeric_keys
from .index import row_index


# A budget of up to so many rows is taken as a top-k, without a sort of the table.
TOP_ROWS = 1 << 17


def shuffled_index(df: DataFrame, keys: Sequence[str], seed: int = 1,
                   out: str = "order_idx") -> DataFrame:
    """Repeatable full shuffle: index rows by (key hash, keys)."""
    h = "_shuffle_h"
    return row_index(df.withColumn(h, key_hash(keys, seed, numeric_keys(df, keys))), [h, *keys],
                     out=out).drop(h)


def repeat_batches(df: DataFrame, keys: Sequence[str], batch_size: int = 64,
                   epochs: int | None = None, steps: int | None = None,
                   shuffle_seed: int | None = None, n_rows: int | None = None) -> DataFrame:
    """Repeat the rows endlessly and cut them into batches of ``batch_size``.

    Position ``p = idx + N * epoch``; ``batch_id = p div batch_size``.
    Batches run across epoch ends; the last one may be short.  The stream is
    cut at ``steps * batch_size`` rows (step budget) or ``epochs * N`` rows.
    Output columns: the input columns, ``epoch``, ``p``, ``batch_id``,
    ``pos_in_batch``.
    """
    if (epochs is None) == (steps is None):
        raise ValueError("give exactly one of epochs or steps")
    wanted = steps * batch_size if steps is not None else None
    if wanted is not None and wanted <= TOP_ROWS and shuffle_seed is None:
        n_rows = df.count() if n_rows is None else n_rows
        if wanted < n_rows:
            # The budget ends inside the first epoch: its rows are a top-k.
            df = df.orderBy(*keys).limit(wanted)
    if shuffle_seed is not None:
        indexed = shuffled_index(df, keys, shuffle_seed, out="_idx")
    else:
        indexed = row_index(df, list(keys), out="_idx")
    n = n_rows if n_rows is not None else indexed.count()
    if n == 0:
        return (indexed.drop("_idx").withColumn("epoch", F.lit(0)).withColumn("p", F.lit(0).cast("bigint"))
                .withColumn("batch_id", F.lit(0).cast("bigint"))
                .withColumn("pos_in_batch", F.lit(0)).limit(0))
    budget = steps * batch_size if steps is not None else epochs * n
    k = max(1, math.ceil(budget / n))
    # Rows past the budget in the last epoch are cut before the explode
    # whenever a single epoch suffices.
    base = indexed.where(F.col("_idx") < F.lit(budget)) if k == 1 else indexed
    out = (base.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
           .withColumn("p", F.col("_idx") + F.lit(n).cast("bigint") * F.col("epoch").cast("bigint"))
           .where(F.col("p") < F.lit(budget))
           .withColumn("batch_id", F.floor(F.col("p") / F.lit(batch_size)).cast("bigint"))
           .withColumn("pos_in_batch", F.pmod(F.col("p"), F.lit(batch_size)).cast("int")))
    return out.drop("_idx")


def shard(df: DataFrame, keys: Sequence[str], n_shards: int, out: str = "shard",
          repartition: bool = True) -> DataFrame:
    """Worker ``w`` keeps rows with ``idx % n == w`` (data sharding by row)."""
    indexed = row_index(df, list(keys), out="_idx")
    tagged = indexed.withColumn(out, F.pmod(F.col("_idx"), F.lit(n_shards)).cast("int")).drop("_idx")
    return tagged.repartitionById(n_shards, F.col(out)) if repartition else tagged
