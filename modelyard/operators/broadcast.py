"""Broadcast only behind a size check.

A side is broadcast when its row count is proven below a bound; beyond it
the plain (shuffled) join is left to Catalyst and AQE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_ROWS = 200_000


def checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_MAX_ROWS,
                      known_rows: int | None = None) -> DataFrame:
    """Return a broadcastable copy of ``df`` if it has at most ``max_rows`` rows.

    ``known_rows`` trusts a bound the caller already holds (e.g. number of
    models) and just hints the broadcast.  Otherwise the side is computed
    once with ``limit(max_rows + 1)``: if it fits, those rows become a local
    relation that is broadcast without being computed again; if not, ``df``
    is returned unchanged for an ordinary join.
    """
    if known_rows is not None:
        return F.broadcast(df) if known_rows <= max_rows else df
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
