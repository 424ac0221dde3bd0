"""Time helpers that do not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_micros(c: str | Column) -> Column:
    """Microseconds since 1970-01-01 of a wall-clock (``timestamp_ntz``) value.

    Both sides of the difference are ``timestamp_ntz``, so the session time
    zone never enters; DuckDB's ``epoch_us`` of a naive timestamp agrees.
    """
    x = F.col(c) if isinstance(c, str) else c
    return F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"),
                            x.cast("timestamp_ntz"))
