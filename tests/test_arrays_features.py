"""Array functions and feature preparation (incl. names with spaces, nulls)."""

import math

from pyspark.sql import functions as F

from modelyard.functions.arrays import (add_axis, array_sum, flatten, max_pool1d, max_pool2d,
                                        relu, scale, softmax)
from modelyard.operators.features import (apply_imputer, domain_values, feature_types,
                                          fit_imputer, fit_levels, one_hot, problem_kind)


def test_pooling_edges(spark):
    df = spark.createDataFrame([([1.0, 5.0, 2.0, 3.0, 9.0],), ([4.0],), ([],)], "a array<double>")
    got = [r[0] for r in df.select(max_pool1d("a", 2)).collect()]
    assert got == [[5.0, 3.0], [], []]   # odd tail dropped, short arrays give []


def test_max_pool2d(spark):
    grid = [[1.0, 2.0, 3.0, 4.0], [5.0, 6.0, 7.0, 8.0], [0.0, 0.0, 9.0, 1.0], [0.0, 2.0, 1.0, 1.0]]
    df = spark.createDataFrame([(grid,)], "a array<array<double>>")
    assert df.select(max_pool2d("a", 2)).first()[0] == [[6.0, 8.0], [2.0, 9.0]]


def test_axis_flatten_roundtrip_and_scale(spark):
    df = spark.createDataFrame([([255.0, 51.0],)], "a array<float>")
    r = df.select(flatten(add_axis(scale("a", 255.0))).alias("f")).first()["f"]
    assert [round(v, 6) for v in r] == [1.0, 0.2]


def test_relu_softmax(spark):
    df = spark.createDataFrame([([-1.0, 0.0, 2.0],)], "a array<float>")
    r = df.select(relu("a").alias("r"), softmax("a").alias("s")).first()
    assert list(r["r"]) == [0.0, 0.0, 2.0]
    assert math.isclose(sum(r["s"]), 1.0)
    assert r["s"][2] == max(r["s"])


def test_feature_types_with_space_in_name(spark):
    df = spark.createDataFrame([(1, "a", 2.0), (2, None, None)], "`Class variable` int, c string, x double")
    ft = {r["column"]: r for r in feature_types(df, exact=True).collect()}
    assert ft["Class variable"]["kind"] == "numeric"
    assert ft["c"]["kind"] == "categorical" and ft["c"]["n_null"] == 1
    assert ft["x"]["n_distinct"] == 1


def test_domain_values_levels(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "c string")
    rows = sorted((r["value"], r["n"], r["level"]) for r in domain_values(df, ["c"]).collect())
    assert rows == [("a", 1, 0), ("b", 2, 1)]


def test_problem_kind(spark):
    df = spark.createDataFrame([(1, 1.5, "x"), (0, 2.5, "y"), (2, 0.5, "z")], "a int, b double, c string")
    kinds = {lbl: problem_kind(df, lbl).first()["kind"] for lbl in ["a", "b", "c"]}
    assert kinds == {"a": "multinomial", "b": "regression", "c": "multinomial"}


def test_imputer_uses_train_rows_only(spark):
    train = spark.createDataFrame([(1.0, "a"), (3.0, "a"), (None, "b"), (5.0, None)], "x double, c string")
    test = spark.createDataFrame([(None, None), (100.0, "z")], "x double, c string")
    stats = fit_imputer(train, ["x"], ["c"])
    assert stats == {"x": 3.0, "c": "a"}
    out = apply_imputer(test, stats, flag_suffix="_was_null").collect()
    assert (out[0]["x"], out[0]["c"], out[0]["x_was_null"]) == (3.0, "a", 1)
    assert (out[1]["x"], out[1]["c"]) == (100.0, "z")


def test_one_hot_unseen_and_null_are_zero(spark):
    train = spark.createDataFrame([("a",), ("b",)], "c string")
    levels = fit_levels(train, "c")
    df = spark.createDataFrame([("a",), ("zzz",), (None,)], "c string")
    rows = [tuple(r) for r in one_hot(df, "c", levels).collect()]
    assert rows == [(1, 0), (0, 0), (0, 0)]


def test_array_sum_null_safe(spark):
    df = spark.createDataFrame([([1.0, 2.0],), (None,)], "a array<double>")
    assert [r[0] for r in df.select(array_sum("a")).collect()] == [3.0, None]
