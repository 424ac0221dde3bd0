"""Registered queries: synchronous training, the endless feed, saved models, fitted preparation."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import functions as F

from ..functions.ids import key_hash_sql
from ..functions.metrics import REGRESSION_METRICS
from ..functions.numeric import round_sig, round_sig_sql
from ..operators.closed_form import fit_closed_form, measure_wide
from ..operators.distinct import RELATIVE_ERROR, distinct_sketches, united
from ..operators.importance import permutation_importance, staged_predictions
from ..operators.measure import best_n, current_metrics, regression_metrics, rounded
from ..operators.model_store import load_model, save_models
from ..operators.prep import LevelEncoder, TableImputer
from ..operators.score_sketch import merge_sketches, score_sketch, sketch_auc
from ..operators.spark_models import fit_candidates, long_predictions, regressors
from ..operators.split import hash_split_col, hash_split_sql, random_split
from ..operators.sync_train import DenseNet, SyncFit, sync_fit
from ..operators.tracking import artifact_locations, autolog, read_log, runs_table
from ..registry import register
from ..session import scratch_path, written_table
from ..sources.tables import load_table
from ..streaming.feed import feed_batches
from ..streaming.sinks import file_stream, score_stream
from .queries_classify import _ROC_CTE, roc_inputs
from .queries_core import (LI_KEYS, PART_FEATURES, PART_FILTER, PART_KEYS, PART_LABEL,
                           REGRESSION_LEADERBOARD_SQL, _part_split_cte, part_trial)
from .queries_ml import _part_features
from .queries_models import CURRENT_METRICS_SQL, REFIT_SQL, _cv_summary
from .queries_split import _batches_sql
from .sqltext import regression_metrics_sql

R = round_sig_sql

# --- The network, trained in step (U1, M7) -----------------------------------

WORKERS = 4

SYNC_SHARDS_SQL = f"""
WITH s AS (SELECT (row_number() OVER (ORDER BY vec_id) - 1) % {WORKERS} AS shard FROM embeddings),
t AS (SELECT count(*) AS n FROM embeddings)
SELECT CAST(shard AS INTEGER) AS shard, count(*) AS n_rows, CAST(ceil(any_value(n) / 64.0) AS BIGINT) AS n_steps,
       true AS loss_fell
FROM s, t GROUP BY shard
"""


@register("sync_network_shards", "U1 M7 R7 R9 E7", SYNC_SHARDS_SQL)
def sync_network_shards(spark, sf_dir):
    """One epoch over 4 workers in step: rows and steps per shard, and whether the loss fell.

    The loss is taken over the whole table, before and after, by a scoring pass.
    """
    e = load_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    fit = sync_fit(e, "embedding", "label", ["vec_id"], 64, WORKERS, epochs=1)
    before = SyncFit(DenseNet(64), [], [])

    def loss(model, name):
        p = model.predict(e, "embedding", 64)
        p_true = F.try_element_at("probability", (F.col("label") + 1).cast("int"))
        return p.agg((-F.avg(F.ln(F.greatest(p_true, F.lit(1e-7))))).alias(name))

    fell = loss(before, "first").join(loss(fit, "last")).select((F.col("last") < F.col("first")).alias("loss_fell"))
    return spark.createDataFrame(fit.workers, "shard int, n_rows bigint, n_steps bigint").join(F.broadcast(fell))


# --- The endless feed as a stream (R7) ---------------------------------------

FEED_SQL = _batches_sql("(CAST(ceil(n / 64.0) AS BIGINT) + 5) * 64") + """
SELECT vec_id, label, epoch, p, CAST(p // 64 AS BIGINT) AS batch_id,
       CAST(p % 64 AS INTEGER) AS pos_in_batch
FROM rows
"""


@register("endless_feed", "R7 R8 ST1", FEED_SQL)
def endless_feed(spark, sf_dir):
    """One epoch and five more batches, fed as a stream that is stopped and restarted between."""
    e = load_table(spark, sf_dir, "embeddings").select("vec_id", "label")
    out = scratch_path(spark, "feed")
    steps = -(-e.count() // 64) + 5
    feed_batches(e, ["vec_id"], out, steps // 2)
    return feed_batches(e, ["vec_id"], out, steps - steps // 2)


# --- Models saved under their run (S7, T8) -----------------------------------

STORE_SQL = f"""
WITH {_part_split_cte()}
SELECT model_id, count(*) AS n_rows, count(*) AS n_equal
FROM hold, (VALUES ('linear'), ('glm'), ('tree'), ('forest'), ('gbt')) m(model_id) GROUP BY model_id
"""


@register("model_store_predictions", "S7 T8 M8 M12", STORE_SQL)
def model_store_predictions(spark, sf_dir):
    """Every Spark ML candidate saved, loaded by run id, and scored beside the fitted one."""
    t, asm = _part_features(spark, sf_dir)
    models = fit_candidates(t.train, [asm], regressors(PART_LABEL, seed=1))
    root = scratch_path(spark, "artifacts")
    names = spark.createDataFrame([(m,) for m in models], "model_id string")
    runs = runs_table(names, "store", "automl").where("nested")
    located = artifact_locations(runs, runs.select("experiment_id").distinct()
                                 .withColumn("artifact_location", F.lit(root)))
    index = save_models(models, located, root)
    out = None
    for row in index.select("run_id", "model_id").collect():
        loaded = load_model(spark, root, row["run_id"])
        fitted = models[row["model_id"]][0].transform(t.holdout).withColumnRenamed("prediction", "fitted")
        both = loaded.transform(fitted.drop("features")).agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("prediction").eqNullSafe(F.col("fitted"))).alias("n_equal"))
        one = both.select(F.lit(row["model_id"]).alias("model_id"), "n_rows", "n_equal")
        out = one if out is None else out.unionByName(one)
    return out


# --- Preparation as fitted stages (F5, F6) -----------------------------------

PREP_KEYS = ["c_custkey"]

PREPARED_SQL = f"""
WITH base AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_acctbal AS DOUBLE) END AS c_acctbal,
                     CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment, c_name,
                     {hash_split_sql(PREP_KEYS, [0.8, 0.2], 1)} AS split FROM customer),
train AS (SELECT * FROM base WHERE split = 0),
mean AS (SELECT avg(c_acctbal) AS m FROM train),
mode AS (SELECT c_mktsegment AS s FROM train WHERE c_mktsegment IS NOT NULL
         GROUP BY c_mktsegment ORDER BY count(*) DESC, c_mktsegment LIMIT 1),
filled AS (SELECT c_custkey, coalesce(c_acctbal, m) AS c_acctbal, coalesce(c_mktsegment, s) AS c_mktsegment, c_name
           FROM base, mean, mode),
ft AS (SELECT coalesce(c_mktsegment, s) AS seg, c_name FROM train, mode),
seg AS (SELECT seg, row_number() OVER (ORDER BY seg) - 1 AS i, count(*) OVER () AS n FROM (SELECT DISTINCT seg FROM ft)),
nm AS (SELECT c_name, row_number() OVER (ORDER BY c_name) - 1 AS i FROM (SELECT DISTINCT c_name FROM ft))
SELECT c_custkey, {R('c_acctbal')} AS c_acctbal, c_mktsegment, CAST(coalesce(seg.i, -1) AS BIGINT) AS segment_level,
       CAST(coalesce(nm.i, -1) AS BIGINT) AS name_level,
       CAST((SELECT max(n) FROM seg) AS INTEGER) AS vector_size, CAST(coalesce(seg.i, -1) AS INTEGER) AS vector_one
FROM filled f LEFT JOIN seg ON f.c_mktsegment = seg.seg LEFT JOIN nm ON f.c_name = nm.c_name
"""


@register("fitted_preparation", "F5 F6 M1 S7 ST2", PREPARED_SQL)
def fitted_preparation(spark, sf_dir):
    """Imputer and level encoder fitted in a Pipeline, saved, reloaded and applied to a stream.

    ``c_name`` has a level for every train row: levels have no bound.
    """
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.functions import vector_to_array
    c = load_table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_acctbal").cast("double")).alias("c_acctbal"),
        F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("c_mktsegment"), "c_name")
    source = scratch_path(spark, "prep-rows")
    c.write.parquet(source)
    rows = spark.read.schema(c.schema).parquet(source)
    stages = [TableImputer(inputCols=["c_acctbal", "c_mktsegment"]),
              LevelEncoder(inputCols=["c_mktsegment"], indexCols=["segment_level"], outputCols=["segment"]),
              LevelEncoder(inputCols=["c_name"], indexCols=["name_level"])]
    model = Pipeline(stages=stages).fit(rows.where(hash_split_col(PREP_KEYS, [0.8, 0.2], 1) == 0))
    path = scratch_path(spark, "prep-model")
    model.write().save(path)
    out = score_stream(file_stream(spark, source, rows.schema), PipelineModel.load(path),
                       scratch_path(spark, "prep-scored"))
    dense = vector_to_array("segment")
    return spark.read.parquet(out).select(
        "c_custkey", round_sig("c_acctbal").alias("c_acctbal"), "c_mktsegment", "segment_level", "name_level",
        F.size(dense).alias("vector_size"), (F.array_position(dense, 1.0) - 1).cast("int").alias("vector_one"))


# --- The winner alone, on all rows (M15) -------------------------------------

REFIT_WINNER_SQL = f"""
SELECT r.* FROM ({REFIT_SQL}) r JOIN ({REGRESSION_LEADERBOARD_SQL}) b USING (model_id) WHERE b.rank = 1
"""


@register("refit_winner", "M15 M11", REFIT_WINNER_SQL)
def refit_winner(spark, sf_dir):
    """The best candidate of the hold-out leaderboard refitted on every filtered row, and no other."""
    best = best_n(part_trial(spark, sf_dir).board, 1).first()["model_id"]
    features = [f for f in PART_FEATURES if best == f"lsq_{f}"]
    part = load_table(spark, sf_dir, "part").where(PART_FILTER).select(*PART_KEYS, PART_LABEL, *PART_FEATURES)
    fitted = next(m for m in fit_closed_form(part, PART_LABEL, features) if m.model_id == best)
    slope = fitted.coefficients[0][1] if fitted.coefficients else None
    row = [(best, float(fitted.intercept), slope, int(fitted.params["train_rows"]))]
    return rounded(spark.createDataFrame(row, "model_id string, intercept double, slope double, train_rows bigint"),
                   ["intercept", "slope"])


# --- Two-feature least squares as the measure of fitted linear models ---------

_LSQ2_CTE = f"""
{_part_split_cte()},
tr AS (SELECT CAST({PART_LABEL} AS DOUBLE) AS y, CAST({PART_FEATURES[0]} AS DOUBLE) AS x1,
              CAST({PART_FEATURES[1]} AS DOUBLE) AS x2 FROM train),
mom AS (SELECT avg(y) AS my, avg(x1) AS m1, avg(x2) AS m2, var_pop(x1) AS v1, var_pop(x2) AS v2,
               covar_pop(x1, x2) AS c12, covar_pop(x1, y) AS c1, covar_pop(x2, y) AS c2 FROM tr),
co AS (SELECT *, (c1 * v2 - c2 * c12) / (v1 * v2 - c12 * c12) AS b1,
              (c2 * v1 - c1 * c12) / (v1 * v2 - c12 * c12) AS b2 FROM mom),
ho AS (SELECT {PART_KEYS[0]} AS k, CAST({PART_LABEL} AS DOUBLE) AS y, CAST({PART_FEATURES[0]} AS DOUBLE) AS x1,
              CAST({PART_FEATURES[1]} AS DOUBLE) AS x2 FROM hold),
linear AS (SELECT k, y, my + b1 * (x1 - m1) + b2 * (x2 - m2) AS p FROM ho, co)"""

LINEAR_BOARD_SQL = f"""
WITH {_LSQ2_CTE}
SELECT model_id, {regression_metrics_sql('y', 'p', 7)}
FROM linear, (VALUES ('linear'), ('glm')) m(model_id) GROUP BY model_id
"""


def _linear_trial(spark, sf_dir):
    """Linear regression and Gaussian GLM fitted on the train rows, their hold-out predictions."""
    t, asm = _part_features(spark, sf_dir)
    exact = [c for c in regressors(PART_LABEL, seed=1) if c[0] in ("linear", "glm")]
    models = fit_candidates(t.train, [asm], exact)
    return t, models, long_predictions(models, t.holdout, PART_KEYS, PART_LABEL)


@register("linear_candidates", "M2 M8 M9 E1", LINEAR_BOARD_SQL)
def linear_candidates(spark, sf_dir):
    """The search's exactly solvable candidates on the hold-out, equal to least squares."""
    _, _, preds = _linear_trial(spark, sf_dir)
    return rounded(regression_metrics(preds), REGRESSION_METRICS, 7)


AUTOLOG_SQL = f"""
WITH {_LSQ2_CTE},
met AS (SELECT {regression_metrics_sql('y', 'p', 7)} FROM linear),
runs AS (SELECT model_id, md5(concat_ws('|', md5('run|autolog|exact'), model_id)) AS run_id
         FROM (VALUES ('linear'), ('glm')) m(model_id))
SELECT run_id, model_id AS run_name, key, metric FROM runs,
       (SELECT unnest(['mse', 'rmse', 'mae', 'r2']) AS key, unnest([mse, rmse, mae, r2]) AS metric FROM met)
"""


@register("autolog_metrics", "T7 T2 T4 T9", AUTOLOG_SQL)
def autolog_metrics(spark, sf_dir):
    """What automatic logging around a fit wrote: the metrics of every child run."""
    def fit():
        _, models, preds = _linear_trial(spark, sf_dir)
        names = spark.createDataFrame([(m, {"label": PART_LABEL}) for m in models],
                                      "model_id string, params map<string,string>")
        return names, rounded(regression_metrics(preds), REGRESSION_METRICS, 7)

    path = autolog(fit, "autolog", "exact", scratch_path(spark, "autolog"), ["mse", "rmse", "mae", "r2"],
                   trial="exact")
    names = spark.createDataFrame([("linear",), ("glm",)], "model_id string")
    runs = runs_table(names, "autolog", "exact").where("nested").select("run_id", "run_name")
    return read_log(spark, path).where("kind = 'metric'").join(runs, "run_id").select(
        "run_id", "run_name", "key", "metric")


# --- Importance and history from predictions (E10, E11) ----------------------

_H = key_hash_sql(PART_KEYS, 1)
PERMUTED_SQL = f"""
WITH {_LSQ2_CTE},
o AS (SELECT *, row_number() OVER (ORDER BY {_H.replace(PART_KEYS[0], 'k')}, k) - 1 AS i, count(*) OVER () AS n FROM ho),
w AS (SELECT a.y, a.x1, a.x2, b.x1 AS z1, b.x2 AS z2 FROM o a JOIN o b ON b.i = (a.i + a.n // 2) % a.n),
e AS (SELECT avg(pow(y - (my + b1 * (x1 - m1) + b2 * (x2 - m2)), 2)) AS base,
             avg(pow(y - (my + b1 * (z1 - m1) + b2 * (x2 - m2)), 2)) AS p1,
             avg(pow(y - (my + b1 * (x1 - m1) + b2 * (z2 - m2)), 2)) AS p2 FROM w, co)
SELECT '{PART_FEATURES[0]}' AS variable, {R('base', 7)} AS base, {R('p1', 7)} AS permuted FROM e
UNION ALL SELECT '{PART_FEATURES[1]}', {R('base', 7)}, {R('p2', 7)} FROM e
"""


@register("permutation_importance", "E11", PERMUTED_SQL)
def permutation_importance_q(spark, sf_dir):
    """Rise of the squared error of a fitted linear model when a feature comes from another row."""
    t, models, _ = _linear_trial(spark, sf_dir)
    hold = t.holdout.select(*dict.fromkeys([*PART_KEYS, PART_LABEL, *PART_FEATURES]))
    got = permutation_importance(models["linear"][0].transform, hold, PART_FEATURES, PART_LABEL, PART_KEYS)
    return rounded(got.select("variable", "base", "permuted"), ["base", "permuted"], 7)


STAGED_SQL = f"""
WITH {_part_split_cte()}
SELECT CAST(20 AS BIGINT) AS n_iterations, count(*) AS n_rows, count(*) AS n_last_equal,
       CAST(20 AS BIGINT) AS n_history_equal FROM hold
"""


@register("staged_history", "E10", STAGED_SQL)
def staged_history(spark, sf_dir):
    """Hold-out error after every tree from one scan: the last stage is the model, the errors its history."""
    t, asm = _part_features(spark, sf_dir)
    gbt = [c for c in regressors(PART_LABEL, seed=1) if c[0] == "gbt"]
    model = fit_candidates(t.train, [asm], gbt)["gbt"][0].stages[-1]
    hold = model.transform(asm.transform(t.holdout)).withColumnRenamed("prediction", "whole")
    history = spark.createDataFrame(
        [(i + 1, float(v)) for i, v in enumerate(model.evaluateEachIteration(hold, "squared"))],
        "iteration int, told double")
    staged = staged_predictions(model, hold, ["whole", F.col(PART_LABEL).cast("double").alias("label")])
    same = F.abs(F.col("prediction") - F.col("whole")) <= F.abs("whole") * 1e-9
    per = staged.groupBy("iteration").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(same).alias("equal"),
        F.avg(F.pow(F.col("label") - F.col("prediction"), 2)).alias("mse"))
    return per.join(history, "iteration").agg(
        F.count(F.lit(1)).alias("n_iterations"), F.max("n").alias("n_rows"),
        F.max_by("equal", "iteration").alias("n_last_equal"),
        F.count_if(F.abs(F.col("mse") - F.col("told")) <= F.abs("told") * 1e-9).alias("n_history_equal"))


# --- Mergeable sketches (E5, E6, F2) -----------------------------------------

WIDE, NARROW = 64.0, 2.0 ** -12

BINNED_AUC_SQL = _ROC_CTE + f""",
b AS (SELECT model_id, CAST(floor(score / CASE WHEN model_id = 'n_chars' THEN {WIDE} ELSE {NARROW} END) AS BIGINT) AS bin,
             sum(pos) AS pos, sum(neg) AS neg FROM cnt GROUP BY ALL),
c AS (SELECT *, sum(pos) OVER (PARTITION BY model_id ORDER BY bin DESC ROWS UNBOUNDED PRECEDING) AS cp,
             sum(pos) OVER (PARTITION BY model_id) AS P, sum(neg) OVER (PARTITION BY model_id) AS N FROM b)
SELECT model_id, count(*) AS bins, CAST(sum(pos) AS BIGINT) AS pos, CAST(sum(neg) AS BIGINT) AS neg,
       {R('sum(CAST(neg AS DOUBLE) * (cp - pos + pos / 2.0)) / (CAST(max(P) AS DOUBLE) * max(N))')} AS auc,
       {R('sum(CAST(neg AS DOUBLE) * pos / 2.0) / (CAST(max(P) AS DOUBLE) * max(N))')} AS auc_bound
FROM c GROUP BY model_id
"""


@register("binned_auc", "E5 E6", BINNED_AUC_SQL)
def binned_auc(spark, sf_dir):
    """AUC and its error bound from score histograms of parts of the rows, merged."""
    rows = roc_inputs(spark, sf_dir)
    parts = [score_sketch(rows.where((F.col("model_id") == m) & (F.pmod(F.xxhash64("label", "score"), F.lit(2)) == h)), w)
             for m, w in (("n_chars", WIDE), ("lang_rate", NARROW)) for h in (0, 1)]
    return rounded(sketch_auc(merge_sketches(parts)), ["auc", "auc_bound"])


SKETCH_COLS = ["event_type", "user_id"]
DISTINCT_SQL = "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT CAST(ts AS DATE)) AS n_days, count(*) AS n, "
    f"count(*) - count({c}) AS n_null, true AS close FROM events" for c in SKETCH_COLS)


@register("distinct_sketches", "F2", DISTINCT_SQL)
def distinct_sketches_q(spark, sf_dir):
    """Distinct counts united from daily sketches, within three standard errors of the exact ones."""
    ev = load_table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    kept = written_table(distinct_sketches(ev, SKETCH_COLS, "day"), "distinct-sketches")
    exact = ev.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in SKETCH_COLS])))
    exact = exact.where("value IS NOT NULL").distinct().groupBy("column").agg(F.count(F.lit(1)).alias("exact"))
    return united(kept).join(exact, "column").select(
        "column", "n_days", "n", "n_null",
        (F.abs(F.col("n_distinct") - F.col("exact")) <= F.greatest(3 * RELATIVE_ERROR * F.col("exact"), F.lit(1.0)))
        .alias("close"))


RANDOM_COVER_SQL = "SELECT count(*) AS n, CAST(0 AS BIGINT) AS overlap, CAST(0 AS BIGINT) AS uncovered FROM lineitem"


@register("random_split_cover", "R1", RANDOM_COVER_SQL)
def random_split_cover(spark, sf_dir):
    """The seeded random split takes every row once: rows in two parts, and in none."""
    li = load_table(spark, sf_dir, "lineitem").select(*LI_KEYS)
    parts = random_split(li, [0.8, 0.2], seed=1)
    taken = parts[0].unionByName(parts[1]).groupBy(*LI_KEYS).agg(F.count(F.lit(1)).alias("taken"))
    given = li.groupBy(*LI_KEYS).agg(F.count(F.lit(1)).alias("given"))
    same = [F.col(k).eqNullSafe(F.col(f"g_{k}")) for k in LI_KEYS]
    both = taken.join(given.withColumnsRenamed({k: f"g_{k}" for k in LI_KEYS}), reduce(and_, same), "full")
    t, g = F.coalesce("taken", F.lit(0)), F.coalesce("given", F.lit(0))
    return both.agg(F.sum(t).alias("n"), F.sum(F.greatest(t - g, F.lit(0))).alias("overlap"),
                    F.sum(F.greatest(g - t, F.lit(0))).alias("uncovered"))


# --- Metrics that count when a source is missing (E9) ------------------------

FALLBACK_SQL = f"""
WITH b AS ({CURRENT_METRICS_SQL}),
g AS (SELECT model_id, metric, training, CASE WHEN model_id <> 'mean' THEN validation END AS validation,
             CASE WHEN model_id = 'lsq_{PART_FEATURES[0]}' THEN cv END AS cv FROM b)
SELECT model_id, metric, training, validation, cv, coalesce(cv, validation, training) AS value,
       CASE WHEN cv IS NOT NULL THEN 'cv' WHEN validation IS NOT NULL THEN 'validation'
            WHEN training IS NOT NULL THEN 'training' END AS source FROM g
"""


@register("current_metrics_fallback", "E9", FALLBACK_SQL)
def current_metrics_fallback(spark, sf_dir):
    """One model has CV metrics, another only validation, the mean only training ones."""
    t, summary = _cv_summary(spark, sf_dir)
    cv = summary.select("model_id", *[F.col(f"{m}_mean").alias(m) for m in REGRESSION_METRICS])
    digits = {"training": measure_wide(t.train, t.models, PART_LABEL),
              "validation": measure_wide(t.holdout, t.models, PART_LABEL), "cv": cv}
    digits = {n: rounded(f, REGRESSION_METRICS) for n, f in digits.items()}
    return current_metrics({
        "cv": digits["cv"].where(F.col("model_id") == f"lsq_{PART_FEATURES[0]}"),
        "validation": digits["validation"].where(F.col("model_id") != "mean"),
        "training": digits["training"]})
