"""Fitted models saved under their run and found again by it.

Each model is written below the artifact location of its run, into a folder of
its own attempt; a row of the index, written last, makes it visible.  A save
that is cut short therefore leaves the run's earlier model in place, and a run
saved twice gives its latest model.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

INDEX_SCHEMA = ("run_id string, model_id string, artifact_uri string, stages array<string>, "
                "saved_at timestamp")


def _index_path(root: str) -> str:
    return f"{root.rstrip('/')}/_models"


def save_models(models: Mapping[str, tuple], runs: DataFrame, root: str) -> DataFrame:
    """Save every fitted pipeline under its run; returns the index.

    ``models`` is ``{model_id: (PipelineModel, ...)}`` as the fit functions
    return; ``runs`` has ``run_id``, ``run_name`` (the model id) and
    ``artifact_uri`` (see :func:`~.tracking.artifact_locations`).  A model
    without a run is refused: it could not be found again.
    """
    spark = runs.sparkSession
    found = {r["run_name"]: r for r in
             runs.where(F.col("run_name").isin(list(models))).select("run_id", "run_name", "artifact_uri").collect()}
    lost = sorted(set(models) - set(found))
    if lost:
        raise ValueError(f"no run for models {lost}")
    for model_id, (model, *_) in models.items():
        run = found[model_id]
        uri = f"{run['artifact_uri'].rstrip('/')}/model-{uuid.uuid4().hex[:12]}"
        model.write().save(uri)
        row = [(run["run_id"], model_id, uri, [type(s).__name__ for s in model.stages])]
        (spark.createDataFrame(row, "run_id string, model_id string, artifact_uri string, stages array<string>")
         .withColumn("saved_at", F.current_timestamp())
         .coalesce(1).write.mode("append").parquet(_index_path(root)))
    return model_index(spark, root)


def model_index(spark: SparkSession, root: str) -> DataFrame:
    """The latest saved model of every run; empty where nothing was saved."""
    try:
        rows = spark.read.schema(INDEX_SCHEMA).parquet(_index_path(root))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], INDEX_SCHEMA)
    latest = F.max_by(F.struct("model_id", "artifact_uri", "stages", "saved_at"),
                      F.struct("saved_at", "artifact_uri"))
    return rows.groupBy("run_id").agg(latest.alias("m")).select("run_id", "m.*")


def load_model(spark: SparkSession, root: str, run_id: str):
    """The model saved under ``run_id``; raises ``KeyError`` when there is none."""
    from pyspark.ml import PipelineModel
    row = model_index(spark, root).where(F.col("run_id") == run_id).first()
    if row is None:
        raise KeyError(run_id)
    return PipelineModel.load(row["artifact_uri"])


def load_best(spark: SparkSession, root: str, runs: DataFrame, board: DataFrame):
    """(run_id, model) of the best run of a leaderboard (rank 1) that has a saved model."""
    best = (board.join(runs.select("run_id", F.col("run_name").alias("model_id")), "model_id")
            .join(model_index(spark, root).select("run_id", "artifact_uri"), "run_id")
            .orderBy("rank", "model_id").select("run_id").first())
    if best is None:
        raise KeyError("no saved model on the leaderboard")
    return best["run_id"], load_model(spark, root, best["run_id"])
