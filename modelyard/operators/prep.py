"""Imputing and one-hot encoding as fitted pipeline stages.

What a stage learns is a table, not a handful of params: one row per column for
the imputer, one row per (column, level) for the encoder.  It is written once
when the stage is fitted, saved beside the stage's metadata as Parquet, and
applied by a join, so the number of levels has no bound.  Both models are
stateless: they score batches and streams alike, inside a ``Pipeline``, before
and after a reload.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import Param, Params, TypeConverters
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable,
                             DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..session import written_table
from .features import domain_values

# A level table of a column is broadcast up to this many rows, else shuffled.
SMALL_LEVELS = 100_000


class _TableWriter(MLWriter):
    """Metadata as the built-in stages write it, and the learned table."""

    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:  # noqa: N802 - the name Spark ML calls
        spark = self.instance.table.sparkSession
        DefaultParamsWriter.saveMetadata(self.instance, path, spark)
        self.instance.table.write.parquet(f"{path}/table")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = self.cls()
        model._resetUid(metadata["uid"])  # noqa: SLF001 - what DefaultParamsReader does
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.table = spark.read.schema(self.cls.TABLE).parquet(f"{path}/table")
        return model


class _TableModel(Model, MLWritable, MLReadable):
    """A model whose state is the DataFrame ``table``."""

    TABLE = ""
    table: DataFrame | None = None

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)

    def copy(self, extra=None):
        out = super().copy(extra)
        out.table = self.table
        return out


def _names(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=TypeConverters.toListString)  # noqa: SLF001


class _ImputerParams(Params):
    inputCols = _names("inputCols", "columns to fill: numbers with the mean, others with the mode")

    def columns(self) -> list[str]:
        return self.getOrDefault(self.inputCols)


class TableImputerModel(_TableModel, _ImputerParams):
    """Fills nulls; a column that had no value on the train rows stays as it is."""

    TABLE = "column string, mean double, mode string"

    def _transform(self, dataset: DataFrame) -> DataFrame:
        # One row per input column: bounded by the width of the schema.
        fill = {r["column"]: r for r in self.table.collect()}
        out = {}
        for c in self.columns():
            row, col = fill.get(c), F.col(f"`{c}`")
            if row is None:
                continue
            if isinstance(dataset.schema[c].dataType, NumericType):
                out[c] = F.coalesce(col.cast("double"), F.lit(row["mean"]))
            else:
                out[c] = F.coalesce(col.cast("string"), F.lit(row["mode"]))
        return dataset.withColumns(out) if out else dataset


class TableImputer(Estimator, _ImputerParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the mean of numeric and the mode of other columns (ties: least value).

    One aggregate for the means; value counts, pre-aggregated on every task,
    for the modes.  Numbers come out as double, other types as string.
    """

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TableImputerModel:
        cols = self.columns()
        numeric = [c for c in cols if isinstance(dataset.schema[c].dataType, NumericType)]
        other = [c for c in cols if c not in numeric]
        parts = []
        if numeric:
            means = dataset.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}")
                                  for i, c in enumerate(numeric)])
            parts.append(means.select(F.inline(F.array(*[
                F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean"),
                         F.lit(None).cast("string").alias("mode")) for i, c in enumerate(numeric)]))))
        if other:
            values = dataset.select(F.inline(F.array(*[
                F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
                for c in other]))).where("value IS NOT NULL")
            counts = values.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
            parts.append(counts.groupBy("column").agg(
                F.lit(None).cast("double").alias("mean"),
                F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("mode")))
        table = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        model = TableImputerModel()
        model._set(inputCols=cols)  # noqa: SLF001
        model.table = written_table(table.where("mean IS NOT NULL OR mode IS NOT NULL"), "imputer")
        return model


class _EncoderParams(Params):
    inputCols = _names("inputCols", "categorical columns")
    indexCols = _names("indexCols", "level number of each column (-1: null or not seen)")
    outputCols = _names("outputCols", "one-hot vector of each column; none when empty")

    def columns(self) -> list[tuple[str, str, str | None]]:
        vectors = self.getOrDefault(self.outputCols)
        return [(c, i, vectors[k] if vectors else None) for k, (c, i) in enumerate(
            zip(self.getOrDefault(self.inputCols), self.getOrDefault(self.indexCols)))]


class LevelEncoderModel(_TableModel, _EncoderParams):
    """Level numbers and sparse one-hot vectors from the learned levels.

    A null or unseen value has number -1 and a vector of zeros.
    """

    TABLE = "column string, value string, n bigint, level bigint"

    def sizes(self) -> dict[str, int]:
        """Levels per column (one row per input column)."""
        if not hasattr(self, "_sizes"):
            self._sizes = {r["column"]: r["n"] for r in self.table.groupBy("column").agg(
                F.count(F.lit(1)).alias("n")).collect()}
        return self._sizes

    def _transform(self, dataset: DataFrame) -> DataFrame:
        from pyspark.ml.feature import OneHotEncoder
        out = dataset
        for k, (col, index, vector) in enumerate(self.columns()):
            n = self.sizes().get(col, 0)
            levels = self.table.where(F.col("column") == col).select(
                F.col("value").alias(f"mk_value{k}"), F.col("level").alias(f"mk_level{k}"))
            if n <= SMALL_LEVELS:
                levels = F.broadcast(levels)
            out = (out.join(levels, F.col(f"`{col}`").cast("string") == F.col(f"mk_value{k}"), "left")
                   .withColumn(index, F.coalesce(F.col(f"mk_level{k}"), F.lit(-1)).cast("bigint"))
                   .drop(f"mk_value{k}", f"mk_level{k}"))
            if vector:
                # The encoder only needs the number of levels, told by one row.
                at = f"mk_at{k}"
                one = dataset.sparkSession.createDataFrame([(float(max(n, 1) - 1),)], f"{at} double")
                hot = OneHotEncoder(inputCols=[at], outputCols=[vector], handleInvalid="keep").fit(one)
                known = F.when(F.col(index) < 0, F.lit(max(n, 1))).otherwise(F.col(index)).cast("double")
                out = hot.transform(out.withColumn(at, known)).drop(at)
        return out


class LevelEncoder(Estimator, _EncoderParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the sorted levels of each column; ``n`` counts their train rows.

    Levels are counted and numbered as a table (:func:`~.features.domain_values`),
    so a column may have as many as it likes.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, indexCols=None, outputCols=None):
        super().__init__()
        self._setDefault(outputCols=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> LevelEncoderModel:
        cols = self.getOrDefault(self.inputCols)
        levels = domain_values(dataset.select(*[F.col(f"`{c}`") for c in cols]), cols)
        model = LevelEncoderModel()
        model._set(inputCols=cols, indexCols=self.getOrDefault(self.indexCols),  # noqa: SLF001
                   outputCols=self.getOrDefault(self.outputCols))
        model.table = written_table(levels.select("column", "value", "n", F.col("level").cast("bigint").alias("level")),
                               "levels")
        return model
