"""Registered queries: streaming drain and streaming scoring (ST1, ST2)."""

from __future__ import annotations

from ..functions.numeric import round_sig, round_sig_sql
from ..registry import register
from ..session import scratch_path
from ..sources.tables import load_table, table_path
from ..streaming.sinks import drain_to_table, file_stream, score_stream
from .queries_core import PART_FILTER, _part_split_cte, part_fitted_stages


@register("metric_stream_drain", "ST1 T9",
          "SELECT event_id, user_id, event_type, value FROM events")
def metric_stream_drain(spark, sf_dir):
    """events arrive as files and are appended once to a sink table, then read back."""
    schema = load_table(spark, sf_dir, "events").schema
    stream = file_stream(spark, table_path(sf_dir, "events"), schema, max_files_per_trigger=1000)
    out = drain_to_table(stream.select("event_id", "user_id", "event_type", "value"),
                         scratch_path(spark, "metric-sink"))
    return spark.read.parquet(out).select("event_id", "user_id", "event_type", "value")


STREAM_SCORE_SQL = f"""
WITH {_part_split_cte()}
SELECT p_partkey, {round_sig_sql('a0 + b0 * CAST(p_partkey AS DOUBLE)')} AS prediction
FROM part, coef WHERE {PART_FILTER}
"""


@register("stream_scoring", "ST2 M8", STREAM_SCORE_SQL)
def stream_scoring(spark, sf_dir):
    """The fitted pipeline (filter + least squares) scores part read as a stream."""
    _, model = part_fitted_stages(spark, sf_dir)
    schema = load_table(spark, sf_dir, "part").schema
    stream = file_stream(spark, table_path(sf_dir, "part"), schema)
    out = score_stream(stream, model, scratch_path(spark, "scored"),
                       columns=["p_partkey", "prediction"])
    return spark.read.parquet(out).select("p_partkey", round_sig("prediction").alias("prediction"))
