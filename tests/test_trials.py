"""Synchronous training, selection, the endless feed, saved models, fitted preparation."""

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.operators.sync_train import DenseNet, sync_fit
from modelyard.session import ship_package


# -- synchronous steps ---------------------------------------------------------

def _rows(spark, n=150, width=6, classes=3):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(n, width))
    y = rng.integers(0, classes, n)
    rows = [(int(i), [float(v) for v in x[i]], int(y[i])) for i in rng.permutation(n)]
    return x, y, spark.createDataFrame(rows, "k long, x array<double>, y int").repartition(5)


def _plain(x, y, steps, batch, **args):
    """The same training in one process, row by row in key order."""
    net = DenseNet(x.shape[1], **args)
    losses = []
    for s in range(steps):
        i = np.arange(s * batch, (s + 1) * batch) % len(y)
        losses.append(net.step(net.sums(x[i], y[i])))
    return net, losses


@pytest.mark.parametrize("n_tasks", [1, 2, 4])
@pytest.mark.parametrize("optimizer", ["rmsprop", "sgd"])
def test_workers_in_step_equal_one_process(spark, n_tasks, optimizer):
    ship_package(spark)
    x, y, df = _rows(spark)
    args = {"hidden": 64, "classes": 3, "seed": 4, "rate": 0.01, "optimizer": optimizer}
    fit = sync_fit(df, "x", "y", ["k"], 6, n_tasks, batch_size=64, steps=5, **args)
    net, losses = _plain(x, y, 5, 64, **args)
    assert np.abs(fit.net.weights - net.weights).max() < 1e-9
    assert np.allclose(fit.losses, losses, atol=1e-9)
    # 320 positions over 150 rows: two whole epochs and 20 rows more.
    want = [sum(1 for p in range(320) if p % 150 % n_tasks == w) for w in range(n_tasks)]
    assert fit.workers == [(w, want[w], 5) for w in range(n_tasks)]


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(0)
    net = DenseNet(4, hidden=5, classes=3, seed=2)
    x, y = rng.normal(size=(7, 4)), rng.integers(0, 3, 7)
    sums = net.sums(x, y)
    for i in rng.choice(len(net.weights), 12, replace=False):
        w, eps = net.weights.copy(), 1e-6
        net.weights = w.copy()
        net.weights[i] += eps
        up = net.sums(x, y)[1]
        net.weights = w.copy()
        net.weights[i] -= eps
        assert abs((up - net.sums(x, y)[1]) / (2 * eps) - sums[2 + i]) < 1e-5
        net.weights = w


def test_short_batches_idle_workers_and_nulls(spark):
    ship_package(spark)
    df = spark.createDataFrame([(0, [1.0, 0.0], 0), (1, [0.0, 1.0], 1), (2, None, 1), (3, [1.0, 1.0], None)],
                               "k long, x array<double>, y int")
    fit = sync_fit(df, "x", "y", ["k"], 2, 4, epochs=3, batch_size=4, hidden=3, classes=2)
    assert [w[1] for w in fit.workers] == [3, 3, 0, 0] and fit.workers[0][2] == 2
    got = {r["k"]: r for r in fit.predict(df, "x", 2).collect()}
    assert got[2]["prediction"] is None and got[2]["probability"] is None
    assert all(math.isclose(sum(got[k]["probability"]), 1.0) for k in (0, 1, 3))
    with pytest.raises(ValueError):
        sync_fit(df.limit(0), "x", "y", ["k"], 2, 1, steps=1)


def test_a_step_does_not_wait_for_a_barrier(spark):
    """A barrier takes a second a step; more workers than slots are no hindrance either."""
    ship_package(spark)
    x, y, df = _rows(spark, n=90)
    slots = spark.sparkContext.defaultParallelism
    args = {"hidden": 8, "classes": 3}
    sync_fit(df, "x", "y", ["k"], 6, 2, batch_size=16, steps=2, **args)
    begun = time.monotonic()
    fit = sync_fit(df, "x", "y", ["k"], 6, slots + 1, batch_size=16, steps=70, **args)
    assert time.monotonic() - begun < 50
    net, losses = _plain(x, y, 70, 16, **args)
    assert np.abs(fit.net.weights - net.weights).max() < 1e-9 and len(fit.losses) == 70
    assert fit.workers == [(w, sum(1 for p in range(70 * 16) if p % 90 % (slots + 1) == w), 70)
                           for w in range(slots + 1)]


# -- selection -----------------------------------------------------------------

def test_selection_equals_sorting(spark):
    from modelyard.functions.ids import key_hash
    from modelyard.operators.split import stratified_holdout, stratified_kfold
    rows = [(i, f"k{i % 700}", [None, "a", "b", "c"][min(i % 10, 3)]) for i in range(3000)]
    df = spark.createDataFrame(rows, "k long, t string, c string").repartition(6)
    for keys in (["k"], ["t", "k"]):
        numeric = keys == ["k"]
        ordered = df.select("k", "c", key_hash(keys, 3, numeric).alias("h"), *[F.col(x).alias(f"o_{x}") for x in keys])
        ranks = {}
        for r in sorted(ordered.collect(), key=lambda r: (r["h"], *[r[f"o_{x}"] for x in keys])):
            ranks.setdefault(r["c"], []).append(r["k"])
        for share in (0.7, 0.0, 1.0, 0.3337):
            got = {r["k"]: r["split"] for r in stratified_holdout(df, "c", keys, share, seed=3).collect()}
            assert len(got) == 3000
            for members in ranks.values():
                cut = math.floor(len(members) * round(share * 10_000) / 10_000)
                assert [got[k] for k in members] == [0] * cut + [1] * (len(members) - cut)
        folds = {r["k"]: r["fold"] for r in stratified_kfold(df, "c", keys, 4, seed=3).collect()}
        for members in ranks.values():
            assert [folds[k] for k in members] == [i % 4 for i in range(len(members))]


def test_selection_with_tied_hashes_and_clashing_names(spark):
    from modelyard.operators.select import below_cut, bucketed_rank, class_cuts
    rows = [(i, 0 if i < 90 else 5, "x" if i % 3 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "k long, mk_n long, class string")
    h = F.col("mk_n")
    cuts = class_cuts(df, "class", h, ["k"], 5000)
    got = {r["k"]: r for r in below_cut(df, cuts, "class", h, ["k"], "split").collect()}
    for c in ("x", None):
        members = [i for i, _, x in rows if x == c]
        assert [got[k]["split"] for k in members] == [0] * (len(members) // 2) + [1] * (len(members) - len(members) // 2)
        ranked = {r["k"]: (r["r"], r["n"]) for r in bucketed_rank(df, "class", h, ["k"], "r", "n").collect()}
        assert [ranked[k] for k in members] == [(i, len(members)) for i in range(len(members))]
    assert got[4]["mk_n"] == 0
    empty = df.limit(0)
    assert below_cut(empty, class_cuts(empty, "class", h, ["k"], 5000), "class", h, ["k"], "split").count() == 0


def test_holdout_plan_has_no_range_partitions(spark):
    from modelyard.operators.split import stratified_holdout
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("c"))
    plan = stratified_holdout(df, "c", ["k"])._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001
    assert "rangepartitioning" not in plan and "hashpartitioning" not in plan and "Sort" not in plan


# -- the endless feed ----------------------------------------------------------

def test_feed_goes_on_at_the_next_batch(spark, tmp_path):
    from modelyard.operators.batching import repeat_batches
    from modelyard.streaming.feed import feed_batches
    ship_package(spark)
    df = spark.range(150).select(F.col("id").alias("k"), (F.col("id") * 2).alias("y")).repartition(4)
    out = str(tmp_path / "feed")
    assert feed_batches(df, ["k"], out, 2).count() == 128
    assert feed_batches(df, ["k"], out, 1).count() == 192
    fed = feed_batches(df, ["k"], out, 2)
    assert {r[0] for r in spark.read.parquet(out).select("trigger").distinct().collect()} == {0, 1, 2}
    want = repeat_batches(df, ["k"], batch_size=64, steps=5)
    cols = ["k", "y", "epoch", "p", "batch_id", "pos_in_batch"]
    assert sorted(map(tuple, fed.select(*cols).collect())) == sorted(map(tuple, want.select(*cols).collect()))


def test_cut_batch_is_written_again(spark, tmp_path):
    import os
    from modelyard.streaming.feed import feed_batches
    ship_package(spark)
    df = spark.range(10).withColumnRenamed("id", "k")
    out = str(tmp_path / "feed")
    feed_batches(df, ["k"], out, 1, batch_size=4)
    feed_batches(df, ["k"], out, 1, batch_size=4)
    # The second batch was planned and written, but its commit is lost.
    for name in ("1", ".1.crc"):
        path = os.path.join(out, "_checkpoint", "commits", name)
        if os.path.exists(path):
            os.replace(path, str(tmp_path / f"lost{name}"))
    got = feed_batches(df, ["k"], out, 1, batch_size=4)
    assert sorted((r["p"], r["k"]) for r in got.collect()) == [(p, p % 10) for p in range(12)]
    with pytest.raises(ValueError):
        feed_batches(df.limit(0), ["k"], str(tmp_path / "none"), 1)


def test_feed_longer_than_many_epochs(spark, tmp_path):
    from modelyard.streaming.feed import feed_batches
    ship_package(spark)
    df = spark.range(3).withColumnRenamed("id", "k")
    got = feed_batches(df, ["k"], str(tmp_path / "feed"), 5, batch_size=7).collect()
    assert sorted((r["p"], r["k"], r["epoch"], r["batch_id"]) for r in got) == \
        [(p, p % 3, p // 3, p // 7) for p in range(35)]


# -- saved models --------------------------------------------------------------

def _fitted(spark, slope):
    from pyspark.ml import Pipeline
    from modelyard.operators.estimators import LeastSquaresRegressor
    df = spark.range(20).select(F.col("id").alias("x"), (F.col("id") * slope + 1).alias("y"))
    return Pipeline(stages=[LeastSquaresRegressor(featureCol="x", labelCol="y")]).fit(df), df


def test_models_are_found_by_run(spark, tmp_path):
    from modelyard.operators.model_store import load_best, load_model, model_index, save_models
    root = str(tmp_path / "store")
    assert model_index(spark, root).count() == 0
    with pytest.raises(KeyError):
        load_model(spark, root, "r1")
    runs = spark.createDataFrame([("r1", "a", f"{root}/e/a"), ("r2", "b", f"{root}/e/b")],
                                 "run_id string, run_name string, artifact_uri string")
    (one, df), (two, _) = _fitted(spark, 2.0), _fitted(spark, 3.0)
    save_models({"a": (one, 0.1), "b": (two, 0.1)}, runs, root)
    assert load_model(spark, root, "r2").transform(df).where("abs(prediction - (3 * x + 1)) > 1e-9").count() == 0
    save_models({"a": (two,)}, runs, root)               # a later save of a run replaces the earlier one
    assert load_model(spark, root, "r1").transform(df).where("abs(prediction - (3 * x + 1)) > 1e-9").count() == 0
    assert model_index(spark, root).count() == 2
    board = spark.createDataFrame([("a", 2), ("b", 1)], "model_id string, rank int")
    assert load_best(spark, root, runs, board)[0] == "r2"
    with pytest.raises(ValueError):
        save_models({"c": (one,)}, runs, root)


def test_cut_save_leaves_the_earlier_model(spark, tmp_path):
    from modelyard.operators.model_store import load_model, save_models
    root = str(tmp_path / "store")
    runs = spark.createDataFrame([("r1", "a", f"{root}/e/a")], "run_id string, run_name string, artifact_uri string")
    one, df = _fitted(spark, 2.0)
    save_models({"a": (one,)}, runs, root)

    class Broken:
        stages = one.stages

        def write(self):
            raise OSError("gone")
    with pytest.raises(OSError):
        save_models({"a": (Broken(),)}, runs, root)
    assert load_model(spark, root, "r1").transform(df).count() == 20


# -- fitted preparation --------------------------------------------------------

def _prep(spark):
    rows = [(1, 2.0, "b", "x"), (2, None, "a", None), (3, 4.0, None, "x"), (4, 6.0, "a", "y"), (5, None, "b", "x")]
    return spark.createDataFrame(rows, "k int, n double, c string, d string")


def test_imputer_and_encoder_reload(spark, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.feature import VectorAssembler
    from modelyard.operators.prep import LevelEncoder, TableImputer
    df = _prep(spark)
    model = Pipeline(stages=[TableImputer(inputCols=["n", "c"]),
                             LevelEncoder(inputCols=["c", "d"], indexCols=["ci", "di"], outputCols=["cv", "dv"]),
                             VectorAssembler(inputCols=["n", "cv", "dv"], outputCol="features")]).fit(df)
    new = spark.createDataFrame([(9, None, "z", "y"), (10, 1.0, None, None)], df.schema)
    path = str(tmp_path / "model")
    model.write().save(path)
    model.write().overwrite().save(path)
    for m in (model, PipelineModel.load(path), PipelineModel.load(path).copy()):
        got = {r["k"]: r for r in m.transform(df.unionByName(new)).collect()}
        # mean of 2, 4, 6; the mode of a, a, b, b is the least of both
        assert got[2]["n"] == 4.0 and got[3]["c"] == "a"
        assert [(got[k]["ci"], got[k]["di"]) for k in (1, 2, 3, 4, 9, 10)] == \
            [(1, 0), (0, -1), (0, 0), (0, 1), (-1, 1), (0, -1)]
        assert got[1]["features"].toArray().tolist() == [2.0, 0.0, 1.0, 1.0, 0.0]
        assert got[9]["features"].toArray().tolist() == [4.0, 0.0, 0.0, 0.0, 1.0]


def test_levels_have_no_bound_and_empty_columns_work(spark):
    from modelyard.operators import prep
    from modelyard.operators.prep import LevelEncoder, TableImputer
    many = spark.range(3000).select(F.col("id").alias("k"), F.concat(F.lit("v"), "id").alias("c"),
                                    F.lit(None).cast("string").alias("e"), F.lit(None).cast("int").alias("i"))
    encoder = LevelEncoder(inputCols=["c", "e"], indexCols=["ci", "ei"], outputCols=["cv", "ev"]).fit(many)
    was, prep.SMALL_LEVELS = prep.SMALL_LEVELS, 10     # past this the levels are joined, not broadcast
    try:
        got = encoder.transform(many).select("k", "ci", "ei", "cv").collect()
    finally:
        prep.SMALL_LEVELS = was
    order = {f"v{i}": n for n, i in enumerate(sorted(range(3000), key=str))}
    assert all(r["ci"] == order[f"v{r['k']}"] and r["ei"] == -1 for r in got)
    assert all(r["cv"].size == 3000 and list(r["cv"].indices) == [r["ci"]] for r in got[:50])
    filled = TableImputer(inputCols=["e", "i"]).fit(many).transform(many)
    assert filled.where("e IS NOT NULL OR i IS NOT NULL").count() == 0


# -- fitted candidates, out of fold --------------------------------------------

def test_out_of_fold_predictions_equal_single_fits(spark):
    from pyspark.ml.feature import VectorAssembler
    from modelyard.operators.spark_models import fit_fold_candidates, fold_predictions, regressors
    rng = np.random.default_rng(1)
    x = rng.normal(size=90)
    df = spark.createDataFrame([(i, float(x[i]), float(3 * x[i] + rng.normal()), i % 3) for i in range(90)],
                               "k int, x double, y double, fold int")
    some = [c for c in regressors("y") if c[0] in ("linear", "tree")]
    fitted = fit_fold_candidates(df, [VectorAssembler(inputCols=["x"], outputCol="features")], some, "fold", 3)
    preds = fold_predictions(fitted, df, "fold", ["k"], "y")
    got = {(r["k"], r["model_id"]): r["prediction"] for r in preds.collect()}
    assert len(got) == 180
    rows = df.toPandas()
    for f in range(3):
        train, held = rows[rows.fold != f], rows[rows.fold == f]
        slope, icpt = np.polyfit(train.x, train.y, 1)
        for r in held.itertuples():
            assert math.isclose(got[(r.k, "linear")], icpt + slope * r.x, rel_tol=1e-9, abs_tol=1e-9)
