"""Registered queries: one Spark callable and (where exact) one DuckDB oracle.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole given tables.  Oracle SQL runs in DuckDB over the same parquet files
(views named like the tables).  Computed doubles are rounded to significant
digits on both sides; every output column is aliased the same on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
SURVEY_IDS: dict[str, str] = {}


def register(name: str, ids: str, oracle: str | None = None):
    """Register a query under ``name`` covering survey rows ``ids``."""
    def wrap(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        SURVEY_IDS[name] = ids
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return wrap


def load_all() -> None:
    """Import the modules that register queries."""
    from .plans import (queries_arrays, queries_classify, queries_core,  # noqa: F401
                        queries_features, queries_ml, queries_models, queries_split,
                        queries_stream, queries_track, queries_trials)
