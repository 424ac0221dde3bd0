"""Registered queries: run tracking as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.ids import hash_below, hash_below_sql, key_md5
from ..functions.time import epoch_micros
from ..operators.closed_form import models_frame
from ..operators.measure import REGRESSION_METRICS
from ..operators.tracking import (append_log, artifact_locations, get_or_create_experiments, read_log,
                                  last_active_run, metrics_long, params_long, register_versions,
                                  runs_table, tags_long)
from ..registry import register
from ..session import scratch_path
from ..sources.tables import load_table
from .queries_core import REGRESSION_LEADERBOARD_SQL, part_trial
from .queries_models import TRAINING_PARAMS_SQL

# Names used by the regression trial's tracking rows.
EXPERIMENT = "part"
PARENT_RUN = "regression_trial"
ARTIFACT_ROOT = "artifacts"
TAGS = {"experiment": "part", "source": "modelyard"}


def _exp_name(df):
    return F.concat_ws("-u", F.col("event_type"), F.col("user_id").cast("string"))


EXPERIMENTS_SQL = f"""
WITH ev AS (SELECT event_type || '-u' || CAST(user_id AS VARCHAR) AS name, ts,
                   {hash_below_sql(['event_id'], 'exp', 0.1)} AS b FROM events),
existing AS (SELECT name, md5('existing|' || name) AS experiment_id, min(ts) AS created
             FROM ev WHERE b GROUP BY name),
requested AS (SELECT name, min(ts) AS created FROM ev GROUP BY name)
SELECT name, experiment_id, epoch_us(created) AS created_us, false AS is_new FROM existing
UNION ALL
SELECT r.name, md5(concat_ws('|', 'experiment', r.name)), epoch_us(r.created), true
FROM requested r ANTI JOIN existing e ON r.name = e.name
"""


@register("experiments_get_or_create", "T1", EXPERIMENTS_SQL)
def experiments_get_or_create(spark, sf_dir):
    """Experiments per (event type, user): keep existing ids, create the rest."""
    ev = load_table(spark, sf_dir, "events").select(
        _exp_name(None).alias("name"), "ts", hash_below(["event_id"], "exp", 0.1).alias("b"))
    existing = (ev.where(F.col("b")).groupBy("name").agg(F.min("ts").alias("created"))
                .withColumn("experiment_id", F.md5(F.concat(F.lit("existing|"), F.col("name")))))
    requested = ev.groupBy("name").agg(F.min("ts").alias("created"))
    out = get_or_create_experiments(existing, requested)
    return out.select("name", "experiment_id", epoch_micros("created").alias("created_us"), "is_new")


def trial_runs(spark, sf_dir):
    t = part_trial(spark, sf_dir)
    models = models_frame(spark, t.models)
    exp_id = key_md5([F.lit(EXPERIMENT)], "experiment")
    return t, models, runs_table(models, exp_id, PARENT_RUN)


_EXP_ID_SQL = f"md5(concat_ws('|', 'experiment', '{EXPERIMENT}'))"
_PARENT_SQL = f"md5(concat_ws('|', 'run', {_EXP_ID_SQL}, '{PARENT_RUN}'))"
_RUNS_CTE = f"""
lb AS ({REGRESSION_LEADERBOARD_SQL}),
runs AS (
  SELECT {_PARENT_SQL} AS run_id, CAST(NULL AS VARCHAR) AS parent_run_id, {_EXP_ID_SQL} AS experiment_id,
         '{PARENT_RUN}' AS run_name, 'parent' AS description, false AS nested
  UNION ALL
  SELECT md5(concat_ws('|', {_PARENT_SQL}, model_id)), {_PARENT_SQL}, {_EXP_ID_SQL}, model_id,
         'child', true FROM lb)
"""

RUNS_SQL = f"WITH {_RUNS_CTE} SELECT * FROM runs"


@register("runs", "T2 P13", RUNS_SQL)
def runs(spark, sf_dir):
    """One parent run and one nested child run per fitted candidate."""
    return trial_runs(spark, sf_dir)[2]


PARAMS_LOG_SQL = f"""
WITH {_RUNS_CTE}, p AS ({TRAINING_PARAMS_SQL})
SELECT r.run_id, p.key, p.value FROM p JOIN runs r ON r.run_name = p.model_id AND r.nested
"""


@register("params_log", "T3 P6", PARAMS_LOG_SQL)
def params_log(spark, sf_dir):
    """Every parameter of every child run as a string row."""
    _, models, rs = trial_runs(spark, sf_dir)
    return params_long(rs, models)


METRICS_LOG_SQL = f"""
WITH {_RUNS_CTE},
long AS (UNPIVOT (SELECT model_id, {', '.join(REGRESSION_METRICS)} FROM lb)
         ON {', '.join(REGRESSION_METRICS)} INTO NAME key VALUE value)
SELECT r.run_id, l.key, CAST(l.value AS DOUBLE) AS value
FROM long l JOIN runs r ON r.run_name = l.model_id AND r.nested
"""


@register("metrics_log", "T4 P6", METRICS_LOG_SQL)
def metrics_log(spark, sf_dir):
    """Every leaderboard metric of every child run as a double row."""
    t, _, rs = trial_runs(spark, sf_dir)
    return metrics_long(rs, t.board, REGRESSION_METRICS)


TAGS_SQL = f"""
WITH {_RUNS_CTE}
SELECT run_id, t.key, t.value FROM runs,
  (VALUES {', '.join(f"('{k}', '{v}')" for k, v in TAGS.items())}) t(key, value)
"""


@register("run_tags", "T5", TAGS_SQL)
def run_tags(spark, sf_dir):
    """Experiment tags on every run of the trial."""
    return tags_long(trial_runs(spark, sf_dir)[2], TAGS)


LAST_RUN_SQL = """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS last_run_id, epoch_us(max(ts)) AS last_start_us
FROM events GROUP BY user_id
"""


@register("last_active_run", "T6", LAST_RUN_SQL)
def last_active_run_q(spark, sf_dir):
    """Latest run per user, events read as runs."""
    ev = load_table(spark, sf_dir, "events")
    out = last_active_run(ev, ["user_id"], "event_id", "ts")
    return out.select("user_id", "last_run_id", epoch_micros("last_start").alias("last_start_us"))


ARTIFACTS_SQL = f"""
WITH {_RUNS_CTE}
SELECT run_id, run_name, concat_ws('/', '{ARTIFACT_ROOT}', experiment_id, run_name) AS artifact_uri
FROM runs
"""


@register("artifact_locations", "T8 P12", ARTIFACTS_SQL)
def artifact_locations_q(spark, sf_dir):
    """Artifact URI of every run: experiment location / experiment id / run name."""
    _, _, rs = trial_runs(spark, sf_dir)
    exps = rs.select("experiment_id").distinct().withColumn("artifact_location", F.lit(ARTIFACT_ROOT))
    return artifact_locations(rs, exps).select("run_id", "run_name", "artifact_uri")


BUFFERED_SQL = f"""
WITH p AS ({PARAMS_LOG_SQL}), m AS ({METRICS_LOG_SQL}), t AS ({TAGS_SQL})
SELECT run_id, 'param' AS kind, key, value, CAST(NULL AS DOUBLE) AS metric FROM p
UNION ALL SELECT run_id, 'metric', key, CAST(NULL AS VARCHAR), value FROM m
UNION ALL SELECT run_id, 'tag', key, value, CAST(NULL AS DOUBLE) FROM t
"""


@register("buffered_log", "T9 T3 T4 T5", BUFFERED_SQL)
def buffered_log(spark, sf_dir):
    """Params, metrics and tags of one trial appended in a single write, read back.

    One typed log table: string values for params and tags, doubles for
    metrics (no number is turned into text).  The trial is logged twice, as a
    retry would, and an attempt without its manifest row lies beside it: both
    add nothing.
    """
    t, models, rs = trial_runs(spark, sf_dir)
    frames = [params_long(rs, models).withColumn("kind", F.lit("param")),
              metrics_long(rs, t.board, REGRESSION_METRICS)
              .withColumnRenamed("value", "metric").withColumn("kind", F.lit("metric")),
              tags_long(rs, TAGS).withColumn("kind", F.lit("tag"))]
    path = scratch_path(spark, "tracking-log")
    for _ in range(2):
        append_log(frames, path, trial="regression")
    (read_log(spark, path).withColumns({"trial": F.lit("regression"), "attempt": F.lit("killed")})
     .write.mode("append").parquet(path))
    return read_log(spark, path).select("run_id", "kind", "key", "value", "metric")


REGISTRY_SQL = """
SELECT event_type AS name, event_id AS run_id,
       row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS version
FROM events
"""


@register("registry_versions", "T10", REGISTRY_SQL)
def registry_versions(spark, sf_dir):
    """Events read as model registrations: versions count up per name."""
    ev = load_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("name"), F.col("ts").alias("created"), F.col("event_id").alias("run_id"))
    return register_versions(ev).select("name", "run_id", "version")
