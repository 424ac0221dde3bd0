"""Tracking tables, batching, shards, gang/grouped fits, streaming."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from modelyard.operators.batching import repeat_batches, shard, shuffled_index
from modelyard.operators.gang import gang_map, grouped_least_squares, shard_partials
from modelyard.operators.tracking import (get_or_create_experiments, last_active_run,
                                          register_versions, runs_table)


def test_get_or_create_keeps_existing_ids(spark):
    existing = spark.createDataFrame([("a", "id-a")], "name string, experiment_id string")
    requested = spark.createDataFrame([("a",), ("b",)], "name string")
    out = {r["name"]: r for r in get_or_create_experiments(existing, requested).collect()}
    assert out["a"]["experiment_id"] == "id-a" and not out["a"]["is_new"]
    assert out["b"]["is_new"] and len(out["b"]["experiment_id"]) == 32


def test_runs_parent_and_children(spark):
    models = spark.createDataFrame([("m1",), ("m2",)], "model_id string")
    rs = runs_table(models, "e1", "trial").collect()
    parent = [r for r in rs if not r["nested"]]
    kids = [r for r in rs if r["nested"]]
    assert len(parent) == 1 and len(kids) == 2
    assert all(k["parent_run_id"] == parent[0]["run_id"] for k in kids)


def test_register_versions_and_last_run(spark):
    reg = spark.createDataFrame([("x", 3, "r3"), ("x", 1, "r1"), ("y", 2, "r2"), ("x", 2, "r2b")],
                                "name string, created int, run_id string")
    v = {(r["name"], r["run_id"]): r["version"] for r in register_versions(reg).collect()}
    assert v == {("x", "r1"): 1, ("x", "r2b"): 2, ("x", "r3"): 3, ("y", "r2"): 1}
    last = {r["name"]: r["last_run_id"] for r in last_active_run(reg, ["name"], "run_id", "created").collect()}
    assert last == {"x": "r3", "y": "r2"}


def test_step_budget_batches(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    b = repeat_batches(df, ["k"], batch_size=64, steps=5).toPandas()
    assert len(b) == 320                       # 5 steps x 64 rows
    assert b.groupby("batch_id").size().tolist() == [64] * 5
    assert set(b["epoch"]) == {0, 1, 2, 3}     # batches run across epoch ends
    assert sorted(b["p"]) == list(range(320))


def test_epoch_batches_last_short(spark):
    df = spark.range(100).withColumnRenamed("id", "k")
    b = repeat_batches(df, ["k"], batch_size=64, epochs=1).toPandas()
    assert b.groupby("batch_id").size().tolist() == [64, 36]


def test_shuffled_index_is_a_permutation(spark):
    df = spark.range(500).withColumnRenamed("id", "k").repartition(3)
    idx = shuffled_index(df, ["k"], seed=4).toPandas()
    assert sorted(idx["order_idx"]) == list(range(500))
    assert (idx.sort_values("k")["order_idx"].values != np.arange(500)).any()


def test_shards_round_robin(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    s = {r["k"]: r["shard"] for r in shard(df, ["k"], 3).collect()}
    assert s == {k: k % 3 for k in range(10)}


def test_gang_map_partials(spark):
    df = spark.range(40).select(F.col("id").alias("k"), (F.col("id") % 3).alias("y"))
    sh = shard(df, ["k"], 4, repartition=False)
    parts = gang_map(sh, shard_partials("shard", "y"), "shard int, n long, label_sum long", 4, "shard")
    got = {r["shard"]: (r["n"], r["label_sum"])
           for r in parts.groupBy("shard").agg(F.sum("n").alias("n"), F.sum("label_sum").alias("label_sum")).collect()}
    want = {s: (10, sum(k % 3 for k in range(40) if k % 4 == s)) for s in range(4)}
    assert got == want


def test_grouped_least_squares_hot_group(spark):
    rng = np.random.default_rng(3)
    g = np.where(rng.random(3000) < 0.9, "hot", "cold")
    x = rng.normal(size=3000)
    y = np.where(g == "hot", 1 + 2 * x, -1 + 0.5 * x) + rng.normal(0, 0.01, 3000)
    df = spark.createDataFrame(pd.DataFrame({"g": g, "x": x, "y": y}))
    out = {r["g"]: r for r in grouped_least_squares(df, ["g"], "x", "y").collect()}
    for grp in ["hot", "cold"]:
        m = g == grp
        slope, icpt = np.polyfit(x[m], y[m], 1)
        assert math.isclose(out[grp]["slope"], slope, rel_tol=1e-9)
        assert math.isclose(out[grp]["intercept"], icpt, rel_tol=1e-8, abs_tol=1e-12)
        assert out[grp]["n"] == m.sum()


def test_stream_drain_and_scoring(spark, tmp_path):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer
    from modelyard.operators.estimators import LeastSquaresRegressor
    from modelyard.streaming.sinks import drain_to_table, file_stream, score_stream
    src = str(tmp_path / "src")
    df = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 2.0 + 1).alias("y"))
    df.write.parquet(src)
    stream = file_stream(spark, src, df.schema)
    out = drain_to_table(stream, str(tmp_path / "sink"), str(tmp_path / "ck1"))
    assert spark.read.parquet(out).count() == 50
    model = Pipeline(stages=[SQLTransformer(statement="SELECT * FROM __THIS__ WHERE k >= 10"),
                             LeastSquaresRegressor(featureCol="k", labelCol="y")]).fit(df)
    scored = score_stream(file_stream(spark, src, df.schema), model, str(tmp_path / "scored"),
                          str(tmp_path / "ck2"), columns=["k", "prediction"])
    res = spark.read.parquet(scored).collect()
    assert len(res) == 40 and all(math.isclose(r["prediction"], r["k"] * 2.0 + 1) for r in res)


def test_append_log_keeps_params_text_and_metrics_numeric(spark, tmp_path):
    from modelyard.operators.tracking import append_log, metrics_long, params_long
    models = spark.createDataFrame([("m1", {"label": "y", "alpha": "0.5"})],
                                   "model_id string, params map<string,string>")
    rs = runs_table(models, "e", "p")
    board = spark.createDataFrame([("m1", 1.25)], "model_id string, rmse double")
    path = append_log([params_long(rs, models), metrics_long(rs, board, ["rmse"])], str(tmp_path / "log"))
    rows = {r["key"]: r for r in spark.read.parquet(path).collect()}
    assert rows["label"]["value"] == "y" and rows["label"]["metric"] is None
    assert rows["rmse"]["metric"] == 1.25 and rows["rmse"]["value"] is None


def test_experiment_requested_twice_is_created_once(spark):
    from modelyard.operators.tracking import get_or_create_experiments
    old = spark.createDataFrame([("a", "1")], "name string, experiment_id string")
    new = spark.createDataFrame([("b",), ("b",), ("a",)], "name string")
    assert sorted(r["name"] for r in get_or_create_experiments(old, new).collect()) == ["a", "b"]


def test_append_log_again_adds_nothing(spark, tmp_path):
    from modelyard.operators.tracking import append_log
    path = str(tmp_path / "log")
    one = spark.createDataFrame([("r", "metric", "rmse", 1.0), (None, "metric", "rmse", 3.0)],
                                "run_id string, kind string, key string, metric double")
    two = spark.createDataFrame([("r", "metric", "mae", 2.0)], one.schema)
    for frames in ([one], [one], [one, two]):
        append_log(frames, path)
    rows = spark.read.parquet(path).select("run_id", "key", "metric").collect()
    assert sorted(rows, key=lambda r: r["metric"]) == [("r", "rmse", 1.0), ("r", "mae", 2.0), (None, "rmse", 3.0)]


def test_streams_resume_by_output_folder(spark, tmp_path):
    from pyspark.ml import Pipeline
    from modelyard.operators.estimators import LeastSquaresRegressor
    from modelyard.streaming.sinks import drain_to_table, file_stream, score_stream
    src = str(tmp_path / "src")
    df = spark.range(10).select(F.col("id").alias("k"), (F.col("id") * 2.0).alias("y"))
    model = Pipeline(stages=[LeastSquaresRegressor(featureCol="k", labelCol="y")]).fit(df)
    for n in (1, 2):
        df.write.mode("append").parquet(src)
        for _ in range(2):          # the second call finds nothing new
            out = drain_to_table(file_stream(spark, src, df.schema, max_files_per_trigger=n),
                                 str(tmp_path / "sink"))
            scored = score_stream(file_stream(spark, src, df.schema), model, str(tmp_path / "scored"))
            assert spark.read.parquet(out).count() == spark.read.parquet(scored).count() == 10 * n


def test_each_shard_is_one_task(spark):
    df = spark.range(1000).select((F.col("id") % 4).cast("int").alias("shard"), F.lit(1).alias("y"))
    parts = gang_map(df, shard_partials("shard", "y"), "shard int, n long, label_sum long", 4, "shard")
    got = parts.withColumn("task", F.spark_partition_id()).collect()
    assert sorted(r["shard"] for r in got) == [0, 1, 2, 3] and all(r["n"] == r["label_sum"] == 250 for r in got)
    assert len({r["task"] for r in got}) == 4


def test_grouped_fit_of_repeated_rows_and_null_groups(spark):
    rows = [("a", 1.0, 2.0)] * 400 + [("a", 3.0, 6.0)] * 100 + [(None, 0.0, 1.0), (None, 2.0, 5.0), ("b", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(7)
    got = {r["g"]: r for r in grouped_least_squares(df, ["g"], "x", "y").collect()}
    assert set(got) == {"a", None} and got["a"]["n"] == 500
    assert math.isclose(got["a"]["slope"], 2.0) and math.isclose(got[None]["slope"], 2.0)
    assert math.isclose(got[None]["intercept"], 1.0)


def test_no_models_still_gives_a_parent_run(spark):
    none = spark.createDataFrame([], "model_id string")
    assert [r["nested"] for r in runs_table(none, "e", "p").collect()] == [False]


def _metric(spark, rows, schema="run_id string, key string, metric double"):
    return spark.createDataFrame(rows, schema)


def test_append_log_keeps_new_steps_and_changed_values(spark, tmp_path):
    from modelyard.operators.tracking import append_log, read_log
    path = str(tmp_path / "log")
    stepped = "run_id string, key string, metric double, step int"
    append_log([_metric(spark, [("r", "rmse", 3.0)])], path)
    append_log([_metric(spark, [("r", "rmse", 3.0, s) for s in (1, 2, 3)], stepped)], path)
    append_log([_metric(spark, [("r", "rmse", 2.0)])], path)
    append_log([_metric(spark, [("r", "rmse", 3.0, 2), ("r", "rmse", 3.0, 4)], stepped)], path)
    got = sorted((r["step"] or 0, r["metric"]) for r in read_log(spark, path).collect())
    assert got == [(0, 2.0), (0, 3.0), (1, 3.0), (2, 3.0), (3, 3.0), (4, 3.0)]


def test_trial_is_logged_once_and_keeps_equal_rows(spark, tmp_path):
    from modelyard.operators.tracking import append_log, read_log
    path = str(tmp_path / "log")
    one = _metric(spark, [("r", "rmse", 1.0), ("r", "rmse", 1.0)])
    append_log([one], path, trial="a")
    append_log([_metric(spark, [("r", "rmse", 9.0)])], path, trial="a")   # a retry under another result
    append_log([one.withColumn("note", F.lit("again"))], path, trial="b")
    got = read_log(spark, path)
    assert sorted((r["metric"], r["note"] or "") for r in got.collect()) == \
        [(1.0, ""), (1.0, ""), (1.0, "again"), (1.0, "again")]


def test_killed_and_rival_writers_leave_nothing(spark, tmp_path):
    from modelyard.operators.tracking import append_log, read_log
    path = str(tmp_path / "log")
    assert read_log(spark, path) is None
    row = _metric(spark, [("r", "rmse", 1.0)])
    row.withColumns({"trial": F.lit("a"), "attempt": F.lit("killed")}).write.parquet(path)
    assert read_log(spark, path) is None
    append_log([row], path, trial="a")
    assert read_log(spark, path).count() == 1
    # A rival that committed the same trial later does not count twice.
    row.withColumns({"trial": F.lit("a"), "attempt": F.lit("rival")}).write.mode("append").parquet(path)
    spark.sql("SELECT 'a' AS trial, 'rival' AS attempt, current_timestamp() AS committed_at") \
        .write.mode("append").parquet(path + "/_commits")
    assert [r["metric"] for r in read_log(spark, path).collect()] == [1.0]
