"""User functions shipped to executors.

* ``gang_map``: one gang-scheduled group of tasks (barrier mode) over Arrow
  batches, e.g. one task per data shard; partial results are combined by a
  Spark aggregate, never on the driver.
* ``grouped_least_squares``: a per-group fit in pandas.  Every task reduces
  the batches it reads, so no task holds a whole group; the centred sufficient
  statistics are merged exactly by Spark (Chan et al.'s pairwise update), so
  the answer equals a single-pass fit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from operator import and_

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


def gang_map(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
             schema: str, n_tasks: int, key: str | None = None, order: Sequence[str] = ()) -> DataFrame:
    """Run ``fn`` on ``n_tasks`` partitions launched together (barrier stage).

    Barrier tasks start all at once or not at all, so ``n_tasks`` must not
    exceed the cluster's task slots; that is checked up front.  With ``key``, an
    integer from 0 to ``n_tasks - 1``, task i gets the rows of key i; with
    ``order`` they reach it sorted (a sort that spills, not a buffer of the task).
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if n_tasks > slots:
        raise ValueError(f"barrier stage needs {n_tasks} slots, cluster has {slots}")
    parts = df.repartitionById(n_tasks, F.col(key).cast("int")) if key else df.repartition(n_tasks)
    if order:
        parts = parts.sortWithinPartitions(*order)
    return parts.mapInArrow(fn, schema, barrier=True)


def shard_partials(shard_col: str, label_col: str):
    """Per-task partial count and label sum for each shard seen by the task."""
    def fn(batches):
        sums = [pa.Table.from_batches([b]).select([shard_col, label_col]).group_by(shard_col)
                .aggregate([([], "count_all"), (label_col, "sum")]) for b in batches if b.num_rows]
        if sums:
            t = pa.concat_tables(sums).group_by(shard_col).aggregate(
                [("count_all", "sum"), (f"{label_col}_sum", "sum")])
            out = pa.table({
                "shard": t[shard_col].cast(pa.int32()),
                "n": t["count_all_sum"].cast(pa.int64()),
                "label_sum": t[f"{label_col}_sum_sum"].cast(pa.int64())})
            yield from out.combine_chunks().to_batches()
    return fn


def _batch_stats(x: str, y: str, group_cols: Sequence[str]):
    """Centred sums of every group in each batch of rows."""
    import pandas as pd

    def fn(frames):
        for pdf in frames:
            pdf[[x, y]] = pdf[[x, y]].astype("float64")
            by = pdf.groupby(list(group_cols), dropna=False, sort=False)
            means = by[[x, y]].transform("mean")
            dx, dy = pdf[x] - means[x], pdf[y] - means[y]
            sums = pd.DataFrame({"m2x": dx * dx, "cxy": dx * dy}).groupby(
                [pdf[g] for g in group_cols], dropna=False, sort=False).sum()
            out = by.agg(n=(x, "size"), mx=(x, "mean"), my=(y, "mean")).join(sums)
            yield out.reset_index()
    return fn


def grouped_least_squares(df: DataFrame, group_cols: Sequence[str], x: str, y: str) -> DataFrame:
    """Least squares ``y ~ a + b x`` per group, fitted in pandas per batch of rows.

    Rows stay where they are: every task reduces its Arrow batches to centred
    sums per group, and only those are shuffled and merged, so a group holding
    a third of all rows, equal ones included, is spread over all tasks.
    Rows with a null ``x`` or ``y`` are left out.
    """
    group_cols = list(group_cols)
    data = df.select(*group_cols, x, y).where(F.col(x).isNotNull() & F.col(y).isNotNull())
    types = dict(data.dtypes)
    schema = ", ".join([f"`{g}` {types[g]}" for g in group_cols] +
                       ["n long", "mx double", "my double", "m2x double", "cxy double"])
    # Both uses below read one small checkpointed table, so the rows are read once.
    ensure_checkpoint_dir(df.sparkSession)
    parts = data.mapInPandas(_batch_stats(x, y, group_cols), schema).checkpoint()
    tot = parts.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group_cols)]).agg(
        F.sum("n").alias("_tn"),
        (F.sum(F.col("n") * F.col("mx")) / F.sum("n")).alias("_tmx"),
        (F.sum(F.col("n") * F.col("my")) / F.sum("n")).alias("_tmy"))
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group_cols)]
    merged = parts.join(tot, reduce(and_, same)).groupBy(*group_cols).agg(
        F.first("_tn").alias("_n"), F.first("_tmx").alias("_mx"), F.first("_tmy").alias("_my"),
        F.sum(F.col("m2x") + F.col("n") * (F.col("mx") - F.col("_tmx")) ** 2).alias("_m2x"),
        F.sum(F.col("cxy") + F.col("n") * (F.col("mx") - F.col("_tmx")) * (F.col("my") - F.col("_tmy")))
        .alias("_cxy"))
    slope = F.try_divide(F.col("_cxy"), F.when(F.col("_m2x") > 0, F.col("_m2x")))
    return merged.select(*group_cols, F.col("_n").alias("n"), slope.alias("slope"),
                         (F.col("_my") - slope * F.col("_mx")).alias("intercept"))
