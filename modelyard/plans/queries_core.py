"""Registered queries: the regression trial, sources and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import round_sig, round_sig_sql
from ..registry import register
from ..sources.tables import load_table
from ..operators.split import hash_split_sql
from .regression import regression_trial
from .sqltext import (closed_form_coef_sql, closed_form_preds_sql, leaderboard_sql,
                      regression_metrics_sql)

# Fixed trial settings on `part` (the regression fixture).
PART_LABEL = "p_retailprice"
PART_FEATURES = ["p_partkey", "p_size"]
PART_KEYS = ["p_partkey"]
PART_FILTER = "p_size > 10"


def part_trial(spark, sf_dir):
    part = load_table(spark, sf_dir, "part")
    return regression_trial(part, PART_LABEL, PART_FEATURES, PART_KEYS, where=PART_FILTER,
                            train_share=0.8, seed=1)


def split_cte(table: str, label: str, features: list[str], keys: list[str], where: str) -> str:
    """SQL of the trial's split, train filter and closed-form coefficients."""
    split = hash_split_sql(keys, [0.8, 0.2], 1)
    return f"""
base AS (SELECT *, {split} AS split FROM {table}),
train AS (SELECT * FROM base WHERE split = 0 AND {where}),
hold AS (SELECT * FROM base WHERE split = 1),
coef AS (SELECT {closed_form_coef_sql(label, features)} FROM train)"""


def _part_split_cte() -> str:
    return split_cte("part", PART_LABEL, PART_FEATURES, PART_KEYS, PART_FILTER)


REGRESSION_LEADERBOARD_SQL = f"""
WITH {_part_split_cte()},
pred AS ({closed_form_preds_sql('hold', PART_LABEL, PART_FEATURES, [])}),
met AS (SELECT model_id, {regression_metrics_sql('y', 'p')} FROM pred GROUP BY model_id)
{leaderboard_sql('met', 'rmse')}
"""


@register("regression_leaderboard", "S2 P1 P2 R2 M3 M9 E1 M10", REGRESSION_LEADERBOARD_SQL)
def regression_leaderboard(spark, sf_dir):
    return part_trial(spark, sf_dir).board


# --- The regression trial at volume (lineitem) -------------------------------

LI_LABEL = "l_extendedprice"
LI_FEATURES = ["l_quantity", "l_discount", "l_tax"]
LI_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
LI_FILTER = "l_quantity > 10"

LINEITEM_LEADERBOARD_SQL = f"""
WITH base AS (SELECT *, {hash_split_sql(LI_KEYS, [0.8, 0.2], 1)} AS split FROM lineitem),
train AS (SELECT * FROM base WHERE split = 0 AND {LI_FILTER}),
hold AS (SELECT * FROM base WHERE split = 1),
coef AS (SELECT {closed_form_coef_sql(LI_LABEL, LI_FEATURES)} FROM train),
pred AS ({closed_form_preds_sql('hold', LI_LABEL, LI_FEATURES, [])}),
met AS (SELECT model_id, {regression_metrics_sql('y', 'p')} FROM pred GROUP BY model_id)
{leaderboard_sql('met', 'rmse')}
"""


@register("lineitem_leaderboard", "S2 P1 R2 M3 M9 E1 M10", LINEITEM_LEADERBOARD_SQL)
def lineitem_leaderboard(spark, sf_dir):
    """The same trial on lineitem: 4 candidates scored over every hold-out row."""
    li = load_table(spark, sf_dir, "lineitem")
    return regression_trial(li, LI_LABEL, LI_FEATURES, LI_KEYS, where=LI_FILTER).board


# --- Sources and sinks -------------------------------------------------------

@register("csv_roundtrip", "S1 S4", "SELECT * FROM customer")
def csv_roundtrip(spark, sf_dir):
    """customer -> CSV (shared scratch folder) -> header + inferred types -> source types."""
    from ..session import scratch_path
    from ..sources.tables import cast_like, read_csv, write_csv
    cust = load_table(spark, sf_dir, "customer")
    path = write_csv(cust, scratch_path(spark, "customer-csv"))
    back = read_csv(spark, path)
    return cast_like(back, cust.schema).select(*cust.columns)


@register("catalog_table", "S5", "SELECT * FROM nation")
def catalog_table(spark, sf_dir):
    """nation saved as a catalog table (external, in the shared folder) and read by name."""
    from ..session import scratch_path
    from ..sources.tables import read_table, save_table
    nation = load_table(spark, sf_dir, "nation")
    name = save_table(nation, "modelyard_nation", path=scratch_path(spark, "nation-table"))
    return read_table(spark, name)


PREVIEW_SQL = """
SELECT o_orderkey, o_custkey, substr(o_orderstatus, 1, 20) AS o_orderstatus, o_totalprice,
       epoch_us(o_orderdate) AS o_orderdate_us, substr(o_orderpriority, 1, 20) AS o_orderpriority
FROM orders ORDER BY o_orderkey LIMIT 20
"""


@register("preview", "S6", PREVIEW_SQL)
def preview_q(spark, sf_dir):
    """First 20 orders by key with string cells cut to 20 characters (a top-k)."""
    from ..functions.time import epoch_micros
    from ..sources.tables import preview
    o = load_table(spark, sf_dir, "orders")
    p = preview(o, ["o_orderkey"], n=20, truncate=20)
    return p.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    epoch_micros("o_orderdate").alias("o_orderdate_us"), "o_orderpriority")


# --- Projections and filters -------------------------------------------------

FILTER_STAGE_SQL = f"""
SELECT {', '.join(LI_KEYS)}, l_quantity, l_extendedprice FROM lineitem WHERE {LI_FILTER}
"""


@register("filter_stage", "P1 P2", FILTER_STAGE_SQL)
def filter_stage(spark, sf_dir):
    """``SELECT * FROM __THIS__ WHERE l_quantity > 10`` as an ML stage; pushed to the scan."""
    from pyspark.ml.feature import SQLTransformer
    li = load_table(spark, sf_dir, "lineitem")
    stage = SQLTransformer(statement=f"SELECT * FROM __THIS__ WHERE {LI_FILTER}")
    return stage.transform(li).select(*LI_KEYS, "l_quantity", "l_extendedprice")


@register("rename_columns", "P3",
          "SELECT o_orderkey AS order_key, o_totalprice AS TT_Sec FROM orders")
def rename_columns(spark, sf_dir):
    """A column named with a space and brackets, renamed with ``withColumnsRenamed``."""
    o = load_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").alias("TT (Sec)"))
    return o.withColumnsRenamed({"TT (Sec)": "TT_Sec", "o_orderkey": "order_key"})


POSITIONAL_SQL = f"""
WITH lb AS ({REGRESSION_LEADERBOARD_SQL}),
w AS (SELECT model_id, CAST(n AS DOUBLE) AS n, mse, rmse, mae, rmsle, r2, mean_residual_deviance,
             CAST(rank AS DOUBLE) AS rank FROM lb)
UNPIVOT w ON n, mse, rmse, mae, rmsle, r2, mean_residual_deviance, rank INTO NAME measure VALUE value
"""


@register("positional_columns", "P4", POSITIONAL_SQL)
def positional_columns(spark, sf_dir):
    """Column 0 of the leaderboard is the key, columns 1.. the measures (from the schema)."""
    board = part_trial(spark, sf_dir).board
    key, measures = board.columns[0], board.columns[1:]
    wide = board.select(key, *[F.col(c).cast("double").alias(c) for c in measures])
    return wide.unpivot([key], measures, "measure", "value")


ROW_IDS_SQL = "SELECT event_id, md5(concat_ws('|', 'run', CAST(event_id AS VARCHAR))) AS run_id FROM events"


@register("row_ids", "P14", ROW_IDS_SQL)
def row_ids(spark, sf_dir):
    """Repeatable md5 run ids (``uuid()`` is the random mode)."""
    from ..functions.ids import stable_id
    ev = load_table(spark, sf_dir, "events")
    return ev.select("event_id", stable_id(["event_id"], "run").alias("run_id"))


SQL_AGG_SQL = f"""
SELECT l_returnflag, l_linestatus, CAST(count(*) AS BIGINT) AS n,
       {round_sig_sql('sum(l_quantity)')} AS sum_qty,
       {round_sig_sql('sum(l_extendedprice * (1 - l_discount))')} AS revenue,
       {round_sig_sql('avg(l_discount)')} AS avg_disc
FROM lineitem WHERE l_quantity > 10 GROUP BY l_returnflag, l_linestatus
"""


@register("session_sql", "P16", SQL_AGG_SQL)
def session_sql(spark, sf_dir):
    """Ad-hoc SQL on the session with a DataFrame argument."""
    li = load_table(spark, sf_dir, "lineitem")
    q = """
    SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS sum_qty,
           sum(l_extendedprice * (1 - l_discount)) AS revenue, avg(l_discount) AS avg_disc
    FROM {li} WHERE l_quantity > 10 GROUP BY l_returnflag, l_linestatus
    """
    out = spark.sql(q, li=li)
    return out.select("l_returnflag", "l_linestatus", "n",
                      *[round_sig(c).alias(c) for c in ["sum_qty", "revenue", "avg_disc"]])


# --- Pipelines: fit, replay the filter at predict time, save and reload -----

def part_fitted_stages(spark, sf_dir):
    """Pipeline [filter stage, least squares on p_partkey] fitted on the train rows."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import SQLTransformer
    from ..operators.estimators import LeastSquaresRegressor
    t = part_trial(spark, sf_dir)
    pipe = Pipeline(stages=[
        SQLTransformer(statement=f"SELECT * FROM __THIS__ WHERE {PART_FILTER}"),
        LeastSquaresRegressor(featureCol="p_partkey", labelCol=PART_LABEL)])
    return t, pipe.fit(t.train)


PIPELINE_PRED_SQL = f"""
WITH {_part_split_cte()}
SELECT p_partkey, p_retailprice, {round_sig_sql('a0 + b0 * CAST(p_partkey AS DOUBLE)')} AS prediction
FROM hold, coef WHERE {PART_FILTER}
"""


@register("fitted_stage_predictions", "M1 M8 P1", PIPELINE_PRED_SQL)
def fitted_stage_predictions(spark, sf_dir):
    """Fitted pipeline replayed on the hold-out: the filter drops low rows again."""
    t, model = part_fitted_stages(spark, sf_dir)
    out = model.transform(t.holdout)
    return out.select("p_partkey", "p_retailprice", round_sig("prediction").alias("prediction"))


@register("model_reload", "S7", PIPELINE_PRED_SQL)
def model_reload(spark, sf_dir):
    """The fitted pipeline saved to the shared folder, loaded back, and scored."""
    from pyspark.ml import PipelineModel
    from ..session import scratch_path
    t, model = part_fitted_stages(spark, sf_dir)
    path = scratch_path(spark, "pipeline-model")
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    out = loaded.transform(t.holdout)
    return out.select("p_partkey", "p_retailprice", round_sig("prediction").alias("prediction"))
