"""Selection and ranks inside classes from histograms of a hash, without a sort.

``class_cuts`` finds the k-th smallest hash of every class by refining a radix
histogram: the leading bits tell in which bucket it lies, the next bits where
inside it.  Each pass is one grouped count, pre-aggregated on every task, over
the classes times 2,048 buckets.  ``bucketed_rank`` needs the rank of every row:
it counts rows per bucket once and ranks only inside buckets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import written_table

HASH_BITS = 31
# Bits already settled after each pass.
PASSES = (11, 21, HASH_BITS)
# Cut tables up to this many rows become a local table; larger ones are written.
LOCAL_ROWS = 100_000
BUCKET_ROWS = 1 << 16


def _settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once: a broadcast local table when small, else a written one."""
    rows = df.limit(LOCAL_ROWS + 1).collect()
    if len(rows) <= LOCAL_ROWS:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
    return written_table(df, name)


def _crossing(counts: DataFrame, order: list[str]) -> DataFrame:
    """Per class, the group in which the running count reaches ``mk_need``, and what is needed inside it.

    The window holds one class's buckets, at most 2,048 (or the rows of one hash).
    """
    run = Window.partitionBy("mk_class").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (counts.withColumn("mk_to", F.sum("mk_n").over(run))
            .where((F.col("mk_need") > F.col("mk_to") - F.col("mk_n")) & (F.col("mk_need") <= F.col("mk_to")))
            .withColumn("mk_need", F.col("mk_need") - (F.col("mk_to") - F.col("mk_n"))))


def class_cuts(df: DataFrame, label: str, h: Column, keys: Sequence[str], share_bp: int) -> DataFrame:
    """The last row of the first ``floor(n * share_bp / 10000)`` of every class, by (hash, keys).

    ``(mk_class, mk_hash, mk_last)``: ``mk_last`` is a struct of the keys.  A
    class of which no row is wanted has no line.  ``h`` lies in [0, 2^31).
    Null is a class of its own.
    """
    rows = df.select(F.col(f"`{label}`").alias("mk_class"), h.alias("mk_hash"),
                     F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)]).alias("mk_keys"))
    found, done = None, 0
    for bits in PASSES:
        part = F.shiftright("mk_hash", HASH_BITS - bits)
        if found is None:
            counts = rows.groupBy("mk_class", part.alias("mk_part")).agg(F.count(F.lit(1)).alias("mk_n"))
            need = F.expr(f"(sum(mk_n) over (partition by mk_class) * {int(share_bp)}) div 10000")
            counts = counts.withColumn("mk_need", need)
        else:
            before = F.shiftright("mk_hash", HASH_BITS - done)
            inside = rows.join(found, rows["mk_class"].eqNullSafe(F.col("mk_c")) & (before == F.col("mk_p")))
            by = ["mk_class", part.alias("mk_part"), *(["mk_keys"] if bits == HASH_BITS else [])]
            counts = inside.groupBy(*by).agg(F.count(F.lit(1)).alias("mk_n"), F.first("mk_need").alias("mk_need"))
        cut = _crossing(counts, ["mk_part", "mk_keys"] if bits == HASH_BITS else ["mk_part"])
        if bits < HASH_BITS:
            found = _settled(cut.select(F.col("mk_class").alias("mk_c"), F.col("mk_part").alias("mk_p"), "mk_need"),
                             "class-cuts")
            done = bits
    return _settled(cut.select("mk_class", F.col("mk_part").alias("mk_hash"), F.col("mk_keys").alias("mk_last")),
                    "class-cuts")


def below_cut(df: DataFrame, cuts: DataFrame, label: str, h: Column, keys: Sequence[str], out: str) -> DataFrame:
    """Add ``out``: 0 for rows up to the cut of their class, else 1."""
    mine = F.struct(h.alias("h"), *[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])
    cut = cuts.select(F.col("mk_class"), F.struct(
        F.col("mk_hash").alias("h"), *[F.col(f"mk_last.k{i}").alias(f"k{i}") for i in range(len(keys))])
        .alias("mk_cut"))
    return (df.join(cut, F.col(f"`{label}`").eqNullSafe(F.col("mk_class")), "left")
            .withColumn(out, F.when(mine <= F.col("mk_cut"), 0).otherwise(1).cast("int"))
            .drop("mk_class", "mk_cut"))


def bucketed_rank(df: DataFrame, label: str, h: Column, keys: Sequence[str], out: str, size: str) -> DataFrame:
    """Add ``out``, the 0-based rank of a row in its class by (hash, keys), and ``size``, its rows.

    Buckets are (class, leading hash bits), with enough bits that one holds
    about ``BUCKET_ROWS`` rows even if one class is the whole table.
    """
    bits = min(HASH_BITS, max(0, math.ceil(math.log2(max(df.count(), 1) / BUCKET_ROWS))))
    rows = df.withColumns({"mk_hash": h, "mk_part": F.shiftright(h, HASH_BITS - bits)})
    counts = rows.groupBy(F.col(f"`{label}`").alias("mk_class"), F.col("mk_part").alias("mk_p")).agg(
        F.count(F.lit(1)).alias("mk_n"))
    run = Window.partitionBy("mk_class").orderBy("mk_p").rowsBetween(Window.unboundedPreceding, -1)
    before = _settled(counts.select(
        "mk_class", "mk_p", F.coalesce(F.sum("mk_n").over(run), F.lit(0)).alias("mk_before"),
        F.sum("mk_n").over(Window.partitionBy("mk_class")).alias(size)), "class-buckets")
    inside = Window.partitionBy(f"`{label}`", "mk_part").orderBy("mk_hash", *[f"`{k}`" for k in keys])
    return (rows.withColumn("mk_in", F.row_number().over(inside) - 1)
            .join(before, F.col(f"`{label}`").eqNullSafe(F.col("mk_class"))
                  & (F.col("mk_part") == F.col("mk_p")))
            .withColumn(out, F.col("mk_before") + F.col("mk_in"))
            .drop("mk_hash", "mk_part", "mk_in", "mk_class", "mk_p", "mk_before"))
