"""Run a per-batch Python function over a text column, all other columns kept."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

SLICE_BYTES = 8 << 20


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES):
    """Cut a batch so that each piece holds about ``limit`` bytes of text.

    One row longer than the limit is a piece of its own; no row is cut.
    """
    sizes = pc.binary_length(batch.column(column)).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        held += n or 0
        if held >= limit:
            yield batch.slice(start, i + 1 - start)
            start, held = i + 1, 0
    if start < len(sizes):
        yield batch.slice(start)


def map_text(df: DataFrame, make, fields: list[T.StructField],
             text_col: str = "text", also: list[str] | None = None) -> DataFrame:
    """Append ``fields`` computed from ``text_col`` in Arrow batches.

    ``make()`` is called once per task and returns ``fn(texts, *also)`` which
    takes lists (null texts are None) and returns one list or Arrow array per
    field.  An input column whose name clashes with a new field is replaced.
    """
    also = also or []
    fresh = {f.name.lower() for f in fields}
    base = df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in fresh])
    schema = T.StructType(list(base.schema.fields) + fields)
    width = len(base.columns)

    def run(batches):
        fn = make()
        out = to_arrow_schema(schema)
        tail = [out.field(f.name).type for f in fields]
        for whole in batches:
            for b in text_slices(whole, text_col):
                texts = b.column(text_col).to_pylist()
                cols = fn(texts, *[b.column(c).to_pylist() for c in also])
                arrays = [c if isinstance(c, pa.Array) else pa.array(c, type=t)
                          for c, t in zip(cols, tail)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(i).cast(out.field(i).type) for i in range(width)]
                    + arrays, schema=out)

    return base.mapInArrow(run, schema)


def map_groups(df: DataFrame, keys: list[str], fn, schema: str) -> DataFrame:
    """Apply ``fn(pdf) -> pdf`` to every group of ``keys`` (a bounded number of rows).

    Groups are read one after another from sorted partitions, without a
    transfer of their own, which is faster than a grouped map for many small groups.
    """
    def run(frames):
        rest = None
        for pdf in frames:
            pdf = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            change = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy().nonzero()[0]
            out = [fn(pdf.iloc[a:b]) for a, b in zip(change, change[1:])]
            rest = pdf.iloc[change[-1]:] if len(change) else None
            out = [o for o in out if len(o)]
            if out:
                yield pd.concat(out, ignore_index=True)
        if rest is not None and len(rest):
            yield fn(rest)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)
