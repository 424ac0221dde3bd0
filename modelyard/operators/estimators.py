"""A closed-form Spark ML estimator, so closed-form candidates join Pipelines.

``LeastSquaresRegressor`` fits ``label ~ a + b * feature`` (or the constant
mean when no feature is given) with one aggregate; the fitted model is a
plain projection, so it scores batch and streaming frames alike and is saved
and loaded by Spark ML's default persistence (its coefficients are Params).
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param.shared import HasLabelCol, HasPredictionCol, Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class _LeastSquaresParams(HasLabelCol, HasPredictionCol):
    featureCol = Param(Params._dummy(), "featureCol", "single numeric feature ('' = mean model)",
                       typeConverter=TypeConverters.toString)

    def __init__(self, *args):
        super().__init__(*args)
        self._setDefault(featureCol="", labelCol="label", predictionCol="prediction")

    def getFeatureCol(self) -> str:
        return self.getOrDefault(self.featureCol)


class LeastSquaresModel(Model, _LeastSquaresParams, DefaultParamsReadable, DefaultParamsWritable):
    intercept = Param(Params._dummy(), "intercept", "fitted intercept",
                      typeConverter=TypeConverters.toFloat)
    slope = Param(Params._dummy(), "slope", "fitted slope (0 for the mean model)",
                  typeConverter=TypeConverters.toFloat)
    trainRows = Param(Params._dummy(), "trainRows", "rows used to fit",
                      typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, featureCol="", labelCol="label", predictionCol="prediction",
                 intercept=0.0, slope=0.0, trainRows=0):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        a = F.lit(float(self.getOrDefault(self.intercept)))
        f = self.getFeatureCol()
        pred = a if not f else a + F.lit(float(self.getOrDefault(self.slope))) * F.col(f).cast("double")
        return dataset.withColumn(self.getPredictionCol(), pred)


class LeastSquaresRegressor(Estimator, _LeastSquaresParams, DefaultParamsReadable,
                            DefaultParamsWritable):
    @keyword_only
    def __init__(self, *, featureCol="", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LeastSquaresModel:
        y = F.col(self.getLabelCol()).cast("double")
        f = self.getFeatureCol()
        aggs = [F.avg(y).alias("m"), F.count(y).alias("n")]
        if f:
            x = F.col(f).cast("double")
            aggs += [F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a")]
        r = dataset.agg(*aggs).first()
        if f and r["b"] is not None:
            a, b = r["a"], r["b"]
        else:
            a, b = r["m"], 0.0
        return LeastSquaresModel(featureCol=f, labelCol=self.getLabelCol(),
                                 predictionCol=self.getPredictionCol(),
                                 intercept=float(a) if a is not None else 0.0, slope=float(b),
                                 trainRows=int(r["n"]))
