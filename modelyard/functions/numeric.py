"""Numeric column helpers: rounding for stable comparison, safe casts.

Every helper that has a SQL twin (``*_sql``) builds the same arithmetic so
that a Spark result and a DuckDB result round to identical doubles.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_sig(c: Column | str, digits: int = 9) -> Column:
    """Round to ``digits`` significant digits (0 stays 0, null stays null).

    Metrics are sums whose last bits depend on summation order; rounding to
    significant digits (not decimals) keeps large and small metrics equally
    stable across engines.  Only exact positive powers of ten are used, so
    the result is the same double in any IEEE engine.
    """
    x = F.col(c) if isinstance(c, str) else c
    k = F.lit(digits - 1) - F.floor(F.log10(F.abs(x)))
    up = F.pow(F.lit(10.0), k)
    down = F.pow(F.lit(10.0), -k)
    return (F.when(x.isNull(), F.lit(None).cast("double"))
            .when((x == 0) | F.isnan(x), x)
            .when(k >= 0, F.round(x * up, 0) / up)
            .otherwise(F.round(x / down, 0) * down))


def round_sig_sql(expr: str, digits: int = 9) -> str:
    """DuckDB text of :func:`round_sig`."""
    k = f"({digits - 1} - floor(log10(abs({expr}))))"
    return (f"(CASE WHEN ({expr}) IS NULL THEN NULL WHEN ({expr}) = 0 THEN 0.0 "
            f"WHEN {k} >= 0 THEN round(({expr}) * pow(10.0, {k}), 0) / pow(10.0, {k}) "
            f"ELSE round(({expr}) / pow(10.0, -{k}), 0) * pow(10.0, -{k}) END)")


def quote(name: str) -> str:
    """Backtick-quote a column name for Spark SQL text."""
    return "`" + name.replace("`", "``") + "`"


def double_literal(v: float | None) -> str:
    """Spark SQL text of a double literal (exact round trip of the value)."""
    if v is None:
        return "CAST(NULL AS DOUBLE)"
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def to_float32(c: Column | str) -> Column:
    """``tf.cast(x, float32)``; ``try_cast`` so dirty input gives null."""
    x = F.col(c) if isinstance(c, str) else c
    return x.try_cast("float")


def to_int64(c: Column | str) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return x.try_cast("bigint")


def stringify(c: Column | str) -> Column:
    """Parameter values are logged as strings."""
    x = F.col(c) if isinstance(c, str) else c
    return x.cast("string")


def floatify(c: Column | str) -> Column:
    """Metric values are logged as doubles."""
    x = F.col(c) if isinstance(c, str) else c
    return x.try_cast("double")
