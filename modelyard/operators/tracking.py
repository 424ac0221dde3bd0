"""Run tracking as ordinary tables.

Experiments, runs, params, metrics, tags and the model registry are
DataFrames in long form; logging a trial is one append per table, not one
remote call per value.  Ids are md5 digests of natural keys, so re-running a
trial produces the same ids and appends are idempotent when keyed by them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.ids import artifact_path, key_md5
from .index import row_index

# The columns every log has, and those of its manifest.
LOG_COLUMNS = {"run_id": "string", "kind": "string", "key": "string", "step": "bigint",
               "value": "string", "metric": "double"}
COMMIT_SCHEMA = "trial string, attempt string, committed_at timestamp"


def get_or_create_experiments(existing: DataFrame, requested: DataFrame,
                              name: str = "name", id_col: str = "experiment_id") -> DataFrame:
    """Keep existing experiments (and their ids); create the missing names.

    New names come from a ``left_anti`` join of the requested names against
    the existing ones; their ids are ``md5('experiment|' || name)``.
    ``requested`` may carry extra columns (e.g. ``created``); a name that is
    requested several times is created once.
    """
    new = (requested.dropDuplicates([name]).join(existing.select(name), name, "left_anti")
           .withColumn(id_col, key_md5([F.col(name)], "experiment"))
           .withColumn("is_new", F.lit(True)))
    old = existing.withColumn("is_new", F.lit(False))
    return old.unionByName(new, allowMissingColumns=True)


def runs_table(models: DataFrame, experiment_id: str | Column, parent_name: str,
               model_col: str = "model_id", description: str = "child") -> DataFrame:
    """One parent run and one nested child run per model, named by model.

    ``run_id = md5(parent_run_id || '|' || model_id)``; the parent's id is
    ``md5('run|' || experiment_id || '|' || parent_name)``.
    """
    exp = F.lit(experiment_id) if isinstance(experiment_id, str) else experiment_id
    parent_id = F.md5(F.concat_ws("|", F.lit("run"), exp, F.lit(parent_name)))
    children = models.select(
        F.md5(F.concat_ws("|", parent_id, F.col(model_col))).alias("run_id"),
        parent_id.alias("parent_run_id"), exp.alias("experiment_id"),
        F.col(model_col).cast("string").alias("run_name"),
        F.lit(description).alias("description"), F.lit(True).alias("nested"))
    parent = models.sparkSession.range(1).select(
        parent_id.alias("run_id"), F.lit(None).cast("string").alias("parent_run_id"),
        exp.alias("experiment_id"), F.lit(parent_name).alias("run_name"),
        F.lit("parent").alias("description"), F.lit(False).alias("nested"))
    return parent.unionByName(children)


def params_long(runs: DataFrame, models: DataFrame, model_col: str = "model_id",
                params_col: str = "params") -> DataFrame:
    """Every parameter as a string row: (run_id, key, value)."""
    child = runs.where(F.col("nested")).select("run_id", F.col("run_name").alias(model_col))
    return (models.select(model_col, F.explode(params_col).alias("key", "value"))
            .join(child, model_col)
            .select("run_id", F.col("key").cast("string"), F.col("value").cast("string")))


def metrics_long(runs: DataFrame, board: DataFrame, metric_cols: Sequence[str],
                 model_col: str = "model_id") -> DataFrame:
    """Every metric as a double row: (run_id, key, value), via ``unpivot``."""
    child = runs.where(F.col("nested")).select("run_id", F.col("run_name").alias(model_col))
    long = board.select(model_col, *[F.col(c).cast("double").alias(c) for c in metric_cols]) \
        .unpivot([model_col], list(metric_cols), "key", "value")
    return long.join(child, model_col).select("run_id", "key", "value")


def tags_long(runs: DataFrame, tags: Mapping[str, str]) -> DataFrame:
    """Tags of every run as (run_id, key, value)."""
    m = F.create_map(*[x for k, v in tags.items() for x in (F.lit(k), F.lit(v))])
    return runs.select("run_id", F.explode(m).alias("key", "value"))


def last_active_run(runs: DataFrame, by: Sequence[str], run_id: str, start: str) -> DataFrame:
    """Latest run per group: ``max_by(run_id, (start, run_id))``.

    A grouped aggregate with partial aggregation: a hot group is reduced on
    every executor before the shuffle.
    """
    return runs.groupBy(*by).agg(
        F.max_by(run_id, F.struct(F.col(start), F.col(run_id))).alias("last_run_id"),
        F.max(start).alias("last_start"))


def artifact_locations(runs: DataFrame, experiments: DataFrame, root_col: str = "artifact_location",
                       model_col: str = "run_name") -> DataFrame:
    """``<experiment artifact location>/<experiment_id>/<model>`` per run."""
    return (runs.join(experiments.select("experiment_id", root_col), "experiment_id", "left")
            .withColumn("artifact_uri", artifact_path(F.col(root_col), "experiment_id", model_col)))


def _log_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """The rows of one trial under the columns of the log, plus any of their own."""
    out = None
    for f in frames:
        if "value" in f.columns and f.schema["value"].dataType.simpleString() != "string":
            f = f.withColumnRenamed("value", "metric")
        f = f.withColumns({c: (F.col(c) if c in f.columns else F.lit(None)).cast(t)
                           for c, t in LOG_COLUMNS.items()})
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out.drop("trial", "attempt")


def append_log(frames: Sequence[DataFrame], path: str, fmt: str = "parquet",
               trial: str | None = None) -> str:
    """Buffered logging: union the rows of one trial, append them in one write, commit.

    The log is one typed table: a string ``value`` for params and tags and a
    double ``metric`` for metrics.  A frame whose ``value`` column is numeric
    (as :func:`metrics_long` returns) has it moved to ``metric``, so numbers
    are never turned into text and text is never cast to a number.

    Rows are written first, under the trial and an attempt of its own; a
    manifest row naming both is written last.  :func:`read_log` takes committed
    attempts only, one a trial, so a killed writer leaves nothing to see and
    two writers of one trial count once.

    With ``trial`` a retry is known by that name: only the manifest is read, and
    a committed trial adds nothing.  Without it rows that equal a logged row in
    every column (null equals null) are taken for a retry and left out; a new
    step or a changed value is a row of its own.
    """
    if not frames:
        return path
    rows = _log_rows(frames)
    spark = rows.sparkSession
    attempt = uuid.uuid4().hex
    if trial is None:
        rows = _not_logged(rows, read_log(spark, path, fmt))
        trial = f"rows-{attempt}"
    else:
        done = _commits(spark, path)
        if done is not None and not done.where(F.col("trial") == trial).isEmpty():
            return path
    (rows.withColumns({"trial": F.lit(trial), "attempt": F.lit(attempt)})
     .write.mode("append").format(fmt).save(path))
    (spark.range(1).select(F.lit(trial).alias("trial"), F.lit(attempt).alias("attempt"),
                           F.current_timestamp().alias("committed_at"))
     .write.mode("append").parquet(_manifest(path)))
    return path


def read_log(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """The committed rows of a log, or None where nothing was committed yet.

    One attempt counts per trial, the first to be committed.
    """
    done = _commits(spark, path)
    if done is None:
        return None
    first = done.groupBy("trial").agg(
        F.min_by("attempt", F.struct("committed_at", "attempt")).alias("attempt"))
    rows = spark.read.option("mergeSchema", "true").format(fmt).load(path)
    return rows.join(first, ["trial", "attempt"], "left_semi").drop("trial", "attempt")


def _manifest(path: str) -> str:
    """Folder of the manifest; readers of the log skip names with ``_``."""
    return f"{path.rstrip('/')}/_commits"


def _commits(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(COMMIT_SCHEMA).parquet(_manifest(path))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _not_logged(rows: DataFrame, logged: DataFrame | None) -> DataFrame:
    if logged is None:
        return rows
    names = list(dict.fromkeys([*rows.columns, *logged.columns]))
    mine = rows.withColumns({c: F.lit(None) for c in names if c not in rows.columns})
    old = logged.select(*[(F.col(f"`{c}`") if c in logged.columns else F.lit(None)).alias(f"_{i}")
                          for i, c in enumerate(names)])
    same = [F.col(f"`{c}`").eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(names)]
    return mine.join(old, reduce(and_, same), "left_anti").select(*[F.col(f"`{c}`") for c in rows.columns])


def register_versions(registry: DataFrame, name: str = "name", created: str = "created",
                      run_id: str = "run_id") -> DataFrame:
    """Version numbers per registered name, counting up by (created, run_id).

    Uses the distributed row index grouped by name, so a name with most of
    the registrations is still numbered across many tasks.
    """
    v = row_index(registry, [created, run_id], group_cols=[name], out="_v")
    return v.withColumn("version", (F.col("_v") + 1).cast("bigint")).drop("_v")


def autolog(fit: Callable[[], tuple[DataFrame, DataFrame]], experiment_id: str, parent_name: str,
            path: str, metric_cols: Sequence[str], tags: Mapping[str, str] | None = None,
            trial: str | None = None) -> str:
    """Run ``fit`` and log its runs, params, metrics and tags in one append.

    ``trial`` names the trial for retries, as in :func:`append_log`.

    ``fit`` returns ``(models, board)``: a models frame with ``model_id`` and
    a ``params`` map, and a board with one row per model.  The log is one
    typed table (string ``value`` for params/tags, double ``metric``).
    """
    models, board = fit()
    rs = runs_table(models, experiment_id, parent_name)
    frames = [params_long(rs, models).withColumn("kind", F.lit("param")),
              metrics_long(rs, board, metric_cols).withColumnRenamed("value", "metric")
              .withColumn("kind", F.lit("metric"))]
    if tags:
        frames.append(tags_long(rs, tags).withColumn("kind", F.lit("tag")))
    return append_log(frames, path, trial=trial)
