"""Array (tensor) column functions, all as Spark higher-order functions.

``transform`` / ``aggregate`` / ``zip_with`` run inside the JVM, interpreted and
outside whole-stage codegen; no Python per element.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def scale(arr: str | Column, divisor: float, as_float: bool = True) -> Column:
    """Element-wise ``x / divisor`` (images / 255.0), kept as float32."""
    def f(x):
        y = x / F.lit(float(divisor))
        return y.cast("float") if as_float else y
    return F.transform(_c(arr), f)


def add_axis(arr: str | Column) -> Column:
    """Trailing axis of size 1: ``[a, b]`` -> ``[[a], [b]]``."""
    return F.transform(_c(arr), lambda x: F.array(x))


def flatten(arr: str | Column) -> Column:
    """Nested arrays to one vector (one level)."""
    return F.flatten(_c(arr))


def _windows(n: Column, size: int) -> Column:
    """0..(n div size)-1, empty when fewer than ``size`` elements."""
    k = F.floor(n / F.lit(size)).cast("int")
    return F.when(k > 0, F.sequence(F.lit(0), k - 1)).otherwise(F.array().cast("array<int>"))


def max_pool1d(arr: str | Column, size: int = 2) -> Column:
    """Max over consecutive non-overlapping windows; a short tail is dropped."""
    a = _c(arr)
    return F.transform(_windows(F.size(a), size),
                       lambda i: F.array_max(F.slice(a, i * size + 1, size)))


def max_pool2d(arr: str | Column, size: int = 2) -> Column:
    """2-D max pooling over a nested ``array<array<x>>`` (rows of columns)."""
    a = _c(arr)
    rows = _windows(F.size(a), size)
    cols = _windows(F.size(F.element_at(a, 1)), size)

    def cell(i, j):
        block = F.flatten(F.transform(F.slice(a, i * size + 1, size),
                                      lambda r: F.slice(r, j * size + 1, size)))
        return F.array_max(block)
    return F.transform(rows, lambda i: F.transform(cols, lambda j: cell(i, j)))


def relu(arr: str | Column) -> Column:
    return F.transform(_c(arr), lambda x: F.greatest(x, F.lit(0.0).cast("float")))


def array_sum(arr: str | Column) -> Column:
    """Sum of elements in double precision (null for null arrays)."""
    return F.aggregate(_c(arr), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double"))


def softmax(arr: str | Column) -> Column:
    """``exp(x - max) / sum(exp(x - max))``, numerically stable."""
    a = _c(arr)
    m = F.array_max(a).cast("double")
    e = F.transform(a, lambda x: F.exp(x.cast("double") - m))
    s = F.aggregate(e, F.lit(0.0).cast("double"), lambda acc, x: acc + x)
    return F.transform(e, lambda x: x / s)
