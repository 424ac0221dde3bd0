"""Score histograms, distinct sketches, permutation importance, staged predictions, centroids."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F


def _auc(labels, scores):
    pos = [s for y, s in zip(labels, scores) if y == 1]
    neg = [s for y, s in zip(labels, scores) if y != 1]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("width", [2.0 ** -12, 0.25, 1.0, 64.0])
def test_sketched_auc_lies_within_its_bound(spark, width):
    from modelyard.operators.score_sketch import merge_sketches, score_sketch, sketch_auc, sketch_roc
    rng = np.random.default_rng(5)
    rows = [(m, int(rng.random() < 0.4), float(rng.normal() + (0.8 if m == "good" else 0.0)))
            for m in ("good", "flat") for _ in range(300)]
    df = spark.createDataFrame(rows + [("good", 1, None), ("flat", None, 0.5)],
                               "model_id string, label int, score double").repartition(5)
    halves = [score_sketch(df.where(c), width) for c in ("score < 0", "score >= 0 OR score IS NULL")]
    merged = merge_sketches(halves)
    whole = score_sketch(df, width)
    assert sorted(map(tuple, merged.select(*whole.columns).collect())) == sorted(map(tuple, whole.collect()))
    got = {r["model_id"]: r for r in sketch_auc(merged).collect()}
    for m in ("good", "flat"):
        mine = [r for r in rows if r[0] == m]
        exact = _auc([r[1] for r in mine], [r[2] for r in mine])
        assert abs(got[m]["auc"] - exact) <= got[m]["auc_bound"] + 1e-12
        assert got[m]["pos"] + got[m]["neg"] == 300
        binned = _auc([r[1] for r in mine], [math.floor(r[2] / width) for r in mine])
        assert math.isclose(got[m]["auc"], binned, rel_tol=1e-12)
    last = sketch_roc(merged, width).where("cum_pos = P AND cum_neg = N")
    assert {r["model_id"] for r in last.collect()} == {"good", "flat"}


def test_sketch_of_one_class_or_nothing(spark):
    from modelyard.operators.score_sketch import score_sketch, sketch_auc
    one = spark.createDataFrame([("m", 1, 0.5), ("m", 1, 0.25)], "model_id string, label int, score double")
    assert [(r["auc"], r["pos"], r["neg"]) for r in sketch_auc(score_sketch(one)).collect()] == [(None, 2, 0)]
    assert sketch_auc(score_sketch(one.limit(0))).count() == 0
    with pytest.raises(ValueError):
        score_sketch(one, 0.0)


def test_daily_sketches_unite_to_the_whole(spark):
    from modelyard.operators.distinct import RELATIVE_ERROR, distinct_sketches, united
    df = spark.range(60_000).select(
        (F.col("id") % 7).alias("day"), (F.col("id") * 7919 % 20_011).alias("many"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 5).alias("few")).repartition(4)
    days = distinct_sketches(df, ["many", "few"], "day")
    assert days.count() == 14
    got = {r["column"]: r for r in united(days).collect()}
    assert abs(got["many"]["n_distinct"] - 20_011) <= 3 * RELATIVE_ERROR * 20_011
    assert (got["few"]["n_distinct"], got["few"]["n_null"], got["few"]["n"], got["few"]["n_days"]) == (5, 40_000, 60_000, 7)
    # Another table's sketches join in; days that overlap count once.
    more = distinct_sketches(df.withColumn("many", F.col("many") + 10_000), ["many"], "day")
    both = {r["column"]: r for r in united(days.unionByName(more)).collect()}
    assert abs(both["many"]["n_distinct"] - 30_011) <= 3 * RELATIVE_ERROR * 30_011
    one = {r["day"]: r["n_distinct"] for r in united(days.where("column = 'few'"), ["day"]).collect()}
    assert one == {d: 5 for d in range(7)}


def test_permutation_importance_of_a_known_model(spark):
    from modelyard.operators.importance import permutation_importance
    rng = np.random.default_rng(3)
    x, z = rng.normal(size=400), rng.normal(size=400)
    df = spark.createDataFrame(pd.DataFrame({"k": np.arange(400), "x": x, "z": z, "unused": z * 2, "y": 3 * x + z})).repartition(4)
    score = lambda d: d.withColumn("prediction", 3 * F.col("x") + F.col("z"))
    got = permutation_importance(score, df, ["x", "z", "unused"], "y", ["k"]).collect()
    assert [r["variable"] for r in got] == ["x", "z", "unused"]
    by = {r["variable"]: r for r in got}
    assert by["x"]["base"] < 1e-20 and by["x"]["scaled"] == 1.0 and by["unused"]["relative"] == 0.0
    # A model that is exact has the squared difference of the two rows' values as its rise.
    assert abs(by["x"]["relative"] / (9 * 2 * x.var()) - 1) < 0.2
    assert math.isclose(sum(r["percentage"] for r in got), 1.0)
    flat = permutation_importance(lambda d: d.withColumn("prediction", F.lit(0.0)), df, ["x"], "y", ["k"]).first()
    assert flat["relative"] == 0.0 and flat["scaled"] is None


def test_shift_gives_every_row_another(spark):
    from modelyard.operators.importance import shifted_features
    for n in (1, 2, 7, 50):
        df = spark.range(n).select(F.col("id").alias("k"), F.col("id").alias("x")).repartition(3)
        rows = shifted_features(df, ["x"], ["k"]).collect()
        assert sorted(r["mk_x"] for r in rows) == sorted(r["k"] for r in rows) == list(range(n))
        assert n == 1 or all(r["mk_x"] != r["k"] for r in rows)


def test_staged_predictions_end_at_the_model(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    from modelyard.operators.importance import staged_metrics, staged_predictions
    rng = np.random.default_rng(7)
    x = rng.uniform(0, 6, 200)
    df = spark.createDataFrame(pd.DataFrame({"k": np.arange(200), "x": x, "y": np.sin(x), "fold": np.arange(200) % 2}))
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    model = GBTRegressor(labelCol="y", maxIter=6, maxDepth=2, seed=1).fit(rows)
    whole = {r["k"]: r["prediction"] for r in model.transform(rows).collect()}
    last = {r["k"]: r["prediction"] for r in staged_predictions(model, rows, ["k"]).where("iteration = 6").collect()}
    assert all(math.isclose(whole[k], last[k], rel_tol=1e-12, abs_tol=1e-12) for k in whole)
    per = staged_metrics(model, rows, "y", ["fold"]).collect()
    assert sorted((r["fold"], r["iteration"]) for r in per) == [(f, i) for f in (0, 1) for i in range(1, 7)]
    told = model.evaluateEachIteration(rows, "squared")
    for i, v in enumerate(told, 1):
        mine = sum(r["mse"] * r["n"] for r in per if r["iteration"] == i) / 200
        assert math.isclose(mine, v, rel_tol=1e-9)


def test_centroids_by_vector_sums(spark):
    from modelyard.operators.classify import fit_centroids, predict_centroids
    from modelyard.session import ship_package
    ship_package(spark)
    df = spark.createDataFrame([(1, [0.0, 0.0], "a"), (2, [2.0, 0.0], "a"), (3, [0.0, 9.0], "b"), (4, None, "b")],
                               "k int, v array<float>, c string")
    cents = fit_centroids(df, "v", "c")
    assert cents == [("a", [1.0, 0.0]), ("b", [0.0, 9.0])]
    got = {r["k"]: r for r in predict_centroids(df, "v", cents).collect()}
    assert [got[k]["prediction"] for k in (1, 2, 3, 4)] == ["a", "a", "b", None]
    d = [1.0, 81.0]
    want = np.exp([-x for x in d]) / sum(np.exp([-x for x in d]))
    assert np.allclose(got[1]["probability"], want) and got[4]["probability"] is None
    tie = spark.createDataFrame([(5, [0.5, 4.5], "a")], df.schema)
    assert predict_centroids(tie, "v", [("a", [0.0, 4.5]), ("b", [1.0, 4.5])]).first()["prediction"] == "a"


def test_category_table_has_no_cap(spark):
    from modelyard.operators.classify import fit_category_table, score_category_rate
    rows = [(f"c{i}", i % 2) for i in range(3000)] + [(None, 1), ("c0", 0)]
    df = spark.createDataFrame(rows, "cat string, y int")
    mode, overall, rates = fit_category_table(df, "y", "cat")
    assert mode == 0 or mode == 1
    assert math.isclose(overall, 1501 / 3002) and rates.count() == 3000
    got = score_category_rate(spark.createDataFrame([("c1",), ("c0",), ("new",), (None,)], "cat string"),
                              rates, "cat", overall).collect()
    assert sorted(round(r["score"], 6) for r in got) == sorted([1.0, 0.0, round(overall, 6), round(overall, 6)])


def test_budget_inside_an_epoch_is_a_top_k(spark):
    from modelyard.operators.batching import repeat_batches
    df = spark.range(1000).withColumnRenamed("id", "k").repartition(7)
    b = repeat_batches(df, ["k"], batch_size=64, steps=5).collect()
    assert sorted((r["p"], r["k"], r["epoch"]) for r in b) == [(p, p, 0) for p in range(320)]


def test_each_shard_has_its_own_partition(spark):
    from modelyard.operators.batching import shard
    df = spark.range(100).withColumnRenamed("id", "k")
    got = shard(df, ["k"], 5).withColumn("part", F.spark_partition_id()).select("shard", "part").distinct().collect()
    assert sorted((r["shard"], r["part"]) for r in got) == [(i, i) for i in range(5)]
