"""Distributed row index and running sums, without a one-task window.

``row_number()`` over an unpartitioned window funnels every row through one
task.  Here rows are range-partitioned on the ordering keys (so a hot group
is cut across many tasks), sorted inside each partition and numbered with
``monotonically_increasing_id``.  A per-(partition, group) summary has at
most ``partitions + groups`` rows; offsets come from a window over that small
table and are joined back (broadcast behind a size check).

The ordering keys must be unique within a group: that makes the numbering
deterministic, so a recomputed partition after an executor loss gets the same
numbers.  The tagged frame is also reliably checkpointed (to the shared
``spark.checkpoint.dir``) so counts and ids are read from one copy.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .broadcast import checked_broadcast
from ..session import ensure_checkpoint_dir

_POS_MASK = (1 << 33) - 1
# One summary row per (partition, group): enough for ~1M input splits.
STATS_MAX_ROWS = 2_000_000


def _names(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def _range_tag(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str | Column],
               num_partitions: int | None, checkpoint: bool) -> DataFrame:
    spark = df.sparkSession
    # Without a number, spark.sql.shuffle.partitions is the start and AQE merges
    # small partitions; the input is planned and run once.
    keys = _names(list(group_cols)) + _names(order_cols)
    ranged = df.repartitionByRange(num_partitions, *keys) if num_partitions else df.repartitionByRange(*keys)
    tagged = (ranged.sortWithinPartitions(*keys)
              .withColumn("_mid", F.monotonically_increasing_id()))
    if checkpoint:
        ensure_checkpoint_dir(spark)
        tagged = tagged.checkpoint(eager=True)
    return (tagged
            .withColumn("_pid", F.shiftright("_mid", 33))
            .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit(_POS_MASK)))
            .drop("_mid"))


def row_index(df: DataFrame, order_cols: Sequence[str | Column],
              group_cols: Sequence[str] = (), out: str = "row_idx",
              group_size: str | None = None, num_partitions: int | None = None,
              checkpoint: bool = True) -> DataFrame:
    """Add a dense 0-based index following ``order_cols`` (per group).

    With ``group_cols`` the index restarts at 0 in each group; with
    ``group_size`` the group's row count is added too.
    """
    group_cols = list(group_cols)
    tagged = _range_tag(df, group_cols, order_cols, num_partitions, checkpoint)
    stats = (tagged.groupBy("_pid", *group_cols)
             .agg(F.min("_pos").alias("_first"), F.count(F.lit(1)).alias("_cnt")))
    before = (Window.partitionBy(*group_cols).orderBy("_pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    stats = stats.withColumn("_off", F.coalesce(F.sum("_cnt").over(before), F.lit(0)))
    if group_size:
        stats = stats.withColumn(
            group_size, F.sum("_cnt").over(Window.partitionBy(*group_cols)))
    stats = stats.drop("_cnt")
    # At most partitions + groups rows (tens of bytes each): collected and
    # broadcast up to STATS_MAX_ROWS, else an ordinary join.
    joined = _null_safe_join(tagged, checked_broadcast(stats, STATS_MAX_ROWS), ["_pid", *group_cols])
    return (joined.withColumn(out, F.col("_off") + F.col("_pos") - F.col("_first"))
            .drop("_pid", "_pos", "_first", "_off"))


def _null_safe_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where null equals null; the keys appear once."""
    right = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(f"`{k}`").eqNullSafe(F.col(f"`_r_{k}`"))
    return left.join(right, cond).drop(*[f"_r_{k}" for k in keys])


def _local_cumsum(group_cols: list[str], value_cols: list[str]):
    """Per-partition running sums over Arrow batches, carried across batches.

    Rows arrive sorted by (group, order) inside the partition, so groups are
    contiguous: only the first group of a batch can continue the last group
    of the previous one.
    """
    def fn(batches):
        carry_key, carry = None, None
        for pdf in batches:
            if pdf.empty:
                continue
            vals = pdf[value_cols]
            cs = vals.groupby([pdf[g] for g in group_cols], sort=False).cumsum() \
                if group_cols else vals.cumsum()
            first_key = tuple(pdf[g].iloc[0] for g in group_cols)
            if carry is not None and first_key == carry_key:
                if group_cols:
                    same = pdf[group_cols[0]] == first_key[0]
                    for g, k in zip(group_cols[1:], first_key[1:]):
                        same &= pdf[g] == k
                else:
                    same = slice(None)
                for v in value_cols:
                    cs.loc[same, v] = cs.loc[same, v] + carry[v]
            carry_key = tuple(pdf[g].iloc[-1] for g in group_cols)
            carry = {v: cs[v].iloc[-1] for v in value_cols}
            yield pdf.assign(**{f"_loc_{v}": cs[v].to_numpy() for v in value_cols})
    return fn


def running_sum(df: DataFrame, value_cols: Sequence[str], order_cols: Sequence[str | Column],
                group_cols: Sequence[str] = (), prefix: str = "cum_",
                num_partitions: int | None = None, checkpoint: bool = True,
                method: str = "auto", small_rows: int = 2_000_000) -> DataFrame:
    """Inclusive running sums of ``value_cols`` along ``order_cols`` per group.

    Rows are range-partitioned and sorted once (a hot group spans many
    partitions).  Partition offsets come from a summary of at most
    partitions + groups rows, collected first; it also gives the exact row
    count.  Inside each partition the running sum is then computed either
    by a window over (partition, group) (``"window"``: JVM only, one more
    shuffle -- chosen by ``"auto"`` up to ``small_rows`` rows) or by an
    Arrow-batched pandas pass over the already sorted rows (``"pandas"``:
    no further shuffle -- chosen by ``"auto"`` above it).  Group keys must
    be non-null.
    """
    group_cols = list(group_cols)
    value_cols = list(value_cols)
    tagged = _range_tag(df, group_cols, order_cols, num_partitions, checkpoint)
    spark = df.sparkSession
    stats = tagged.groupBy("_pid", *group_cols).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.sum(v).alias(f"_tot_{v}") for v in value_cols])
    before = (Window.partitionBy(*group_cols).orderBy("_pid")
              .rowsBetween(Window.unboundedPreceding, -1))
    stats = stats.select("_pid", *group_cols, "_rows", *[
        F.coalesce(F.sum(f"_tot_{v}").over(before), F.lit(0)).alias(f"_off_{v}")
        for v in value_cols])
    got = stats.limit(STATS_MAX_ROWS + 1).collect()
    if len(got) <= STATS_MAX_ROWS:
        total = sum(r["_rows"] for r in got)
        offsets = F.broadcast(spark.createDataFrame(got, stats.schema).drop("_rows"))
    else:
        total = None
        offsets = stats.drop("_rows")
    if method == "auto":
        method = "window" if total is not None and total <= small_rows else "pandas"
    if method == "pandas":
        base = tagged.schema
        schema = StructType(list(base.fields) + [
            StructField(f"_loc_{v}", base[v].dataType) for v in value_cols])
        tagged = tagged.mapInPandas(_local_cumsum(group_cols, value_cols), schema)
    else:
        local_w = (Window.partitionBy("_pid", *group_cols).orderBy("_pos")
                   .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        for v in value_cols:
            tagged = tagged.withColumn(f"_loc_{v}", F.sum(v).over(local_w))
    joined = _null_safe_join(tagged, offsets, ["_pid", *group_cols])
    return joined.select(
        *[c for c in df.columns],
        *[(F.col(f"_off_{v}") + F.col(f"_loc_{v}")).alias(f"{prefix}{v}") for v in value_cols])
