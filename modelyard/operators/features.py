"""Feature preparation and introspection.

Statistics (means, modes, category levels) are always taken from the train
rows and then applied to any frame, so hold-out rows never leak into them.
Each statistic is one aggregate pass whose result is a handful of values
per column, collected to the driver and turned back into column
expressions (``coalesce`` / ``when``), so applying them is a projection with
no join and no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DecimalType, DoubleType, FloatType, IntegralType,
                               NumericType, StringType)

from .index import row_index


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def categorical_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, (StringType, BooleanType)) and f.name not in exclude]


def assemble(df: DataFrame, label: str, features: Sequence[str] | None = None,
             out: str = "features", handle_invalid: str = "keep") -> DataFrame:
    """Every usable numeric column except the label becomes a feature (F1)."""
    from pyspark.ml.feature import VectorAssembler
    cols = list(features) if features is not None else numeric_columns(df, [label])
    return VectorAssembler(inputCols=cols, outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def _kind(dt) -> str:
    return "numeric" if isinstance(dt, NumericType) else "categorical"


def feature_types(df: DataFrame, exact: bool = False, exclude: Sequence[str] = ()) -> DataFrame:
    """One row per column: type, numeric/categorical, distinct and null counts (F2).

    One aggregate pass for all columns.  ``exact=False`` uses HyperLogLog
    (``approx_count_distinct``), which is what a large table should use.
    """
    fields = [f for f in df.schema.fields if f.name not in exclude]
    aggs: list[Column] = []
    for i, f in enumerate(fields):
        c = F.col(f"`{f.name}`")
        nd = F.count_distinct(c) if exact else F.approx_count_distinct(c)
        aggs += [nd.alias(f"d{i}"), F.count_if(c.isNull()).alias(f"z{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("dtype"),
                     F.lit(_kind(f.dataType)).alias("kind"),
                     F.col(f"d{i}").cast("bigint").alias("n_distinct"),
                     F.col(f"z{i}").cast("bigint").alias("n_null"))
            for i, f in enumerate(fields)]
    return wide.select(F.inline(F.array(*rows)))


def domain_values(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Levels of each categorical column: (column, value, n, level).

    Long form, one row per distinct value, so a high-cardinality column is
    never gathered into one array or one task; ``level`` is the 0-based
    sorted position from the distributed row index.
    """
    cols = list(cols) if cols is not None else categorical_columns(df)
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
        for c in cols])).alias("cv")).select("cv.column", "cv.value")
    counts = (stacked.where(F.col("value").isNotNull())
              .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
    return row_index(counts, ["value"], group_cols=["column"], out="level")


def problem_kind(df: DataFrame, label: str, max_classes: int = 100) -> DataFrame:
    """regression, binomial or multinomial from the label type and cardinality.

    Floating labels are regression; integral and string labels are classes
    when they have at most ``max_classes`` values (2 -> binomial).  The count
    is exact at every size: distinct values are partially aggregated on every
    task before they are shuffled.  Nulls are no class.
    """
    dt = df.schema[label].dataType
    nd = df.agg(F.count_distinct(F.col(label)).alias("n")).first()["n"]
    if isinstance(dt, (DoubleType, FloatType, DecimalType)):
        kind = "regression"
    elif isinstance(dt, IntegralType):
        kind = "binomial" if nd <= 2 else ("multinomial" if nd <= max_classes else "regression")
    else:
        kind = "binomial" if nd <= 2 else "multinomial"
    return df.sparkSession.createDataFrame(
        [(label, dt.simpleString(), int(nd), kind)],
        "label string, dtype string, n_distinct bigint, kind string")


def fit_imputer(train: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> dict:
    """Mean of each numeric column and mode of each categorical column.

    Means are one aggregate.  Modes are value counts per (column, value) —
    partial aggregation keeps this small — then the most frequent value per
    column (ties: smallest value) via ``min_by``, so the result is
    deterministic.
    """
    stats: dict = {}
    if numeric:
        row = train.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in numeric]).first()
        stats.update({c: row[c] for c in numeric})
    if categorical:
        stacked = train.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
            for c in categorical])).alias("cv")).select("cv.column", "cv.value")
        counts = (stacked.where(F.col("value").isNotNull())
                  .groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")))
        modes = counts.groupBy("column").agg(
            F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")).collect()
        stats.update({r["column"]: r["mode"] for r in modes})
    return stats


def apply_imputer(df: DataFrame, stats: dict, flag_suffix: str | None = None) -> DataFrame:
    """Fill nulls from fitted statistics; optional ``<col><suffix>`` null flags.

    Numeric columns come out as double (a mean need not be integral).
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        v = stats.get(f.name)
        if v is None:
            out.append(c)
            continue
        if isinstance(f.dataType, NumericType):
            out.append(F.coalesce(c.cast("double"), F.lit(float(v))).alias(f.name))
        else:
            out.append(F.coalesce(c.cast("string"), F.lit(str(v))).alias(f.name))
        if flag_suffix:
            out.append(c.isNull().cast("int").alias(f"{f.name}{flag_suffix}"))
    return df.select(*out)


def fit_levels(train: DataFrame, col: str, max_levels: int = 1000) -> list[str]:
    """Sorted levels of a categorical column on the train rows.

    Refuses columns with more than ``max_levels`` levels: one-hot encoding
    them would produce that many columns.
    """
    levels = (train.where(F.col(col).isNotNull()).select(F.col(col).cast("string").alias("v"))
              .distinct().limit(max_levels + 1).collect())
    if len(levels) > max_levels:
        raise ValueError(f"{col} has more than {max_levels} levels; hash or index it instead")
    return sorted(r["v"] for r in levels)


def one_hot(df: DataFrame, col: str, levels: Sequence[str], prefix: str | None = None,
            drop: bool = True) -> DataFrame:
    """One 0/1 column per level: a projection (no pivot, no shuffle).

    A null or unseen category gets all zeros.
    """
    p = prefix if prefix is not None else f"{col}_"
    cols = [F.coalesce((F.col(col) == F.lit(v)).cast("int"), F.lit(0)).alias(f"{p}{v}")
            for v in levels]
    base = [F.col(f"`{c}`") for c in df.columns if not (drop and c == col)]
    return df.select(*base, *cols)
