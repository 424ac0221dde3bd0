"""Distinct counts as mergeable sketches, kept per column and day (F2).

One aggregate pass makes a HyperLogLog sketch of every column for every day, a
few kilobytes each whatever the rows.  Any days, or any tables of sketches,
are united later without going back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_K = 12
# One standard error of an estimate from 2^LG_K registers.
RELATIVE_ERROR = 1.04 / 2 ** (LG_K / 2)


def distinct_sketches(df: DataFrame, cols: Sequence[str], day: str, lg_k: int = LG_K) -> DataFrame:
    """``(column, day, n, n_null, sketch)``: values are sketched as text; nulls are counted apart."""
    aggs = []
    for i, c in enumerate(cols):
        col = F.col(f"`{c}`")
        aggs += [F.hll_sketch_agg(col.cast("string"), lg_k).alias(f"s{i}"), F.count_if(col.isNull()).alias(f"z{i}")]
    daily = df.groupBy(F.col(f"`{day}`").alias("day")).agg(F.count(F.lit(1)).alias("n"), *aggs)
    return daily.select("day", "n", F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"z{i}").alias("n_null"), F.col(f"s{i}").alias("sketch"))
        for i, c in enumerate(cols)]))).select("column", "day", "n", "n_null", "sketch")


def united(sketches: DataFrame, by: Sequence[str] = ("column",)) -> DataFrame:
    """``(by, n_days, n, n_null, n_distinct)`` of the days of each group, from their sketches alone."""
    return sketches.groupBy(*by).agg(
        F.count_distinct("day").alias("n_days"), F.sum("n").alias("n"), F.sum("n_null").alias("n_null"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))
