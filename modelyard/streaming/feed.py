"""The endless batch feed as a stream (R7): a restart goes on at the next batch.

The source is a Python data source whose offset is the position p in the
endlessly repeated rows.  It makes positions only, as Arrow batches on the
executors; the rows come from a join with the table's row index, written once
and sorted by it, so that a micro-batch reads the row groups it needs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from ..operators.index import row_index
from .sinks import _progress

SOURCE = "endless_positions"
# Positions made by one task, and in one Arrow batch.
TASK_POSITIONS, ARROW_POSITIONS = 1 << 22, 1 << 16
SCHEMA = "p bigint, epoch int, row_idx bigint, batch_id bigint, pos_in_batch int"


class PositionSource(DataSource):
    """Options: ``n_rows``, ``batch_size``, ``steps`` a trigger, ``start`` (a position)."""

    @classmethod
    def name(cls) -> str:
        return SOURCE

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema):  # noqa: N802 - the name Spark calls
        return PositionReader(self.options)


class PositionReader(DataSourceStreamReader):
    """Releases ``steps`` batches a trigger; any range of positions can be made again."""

    def __init__(self, options):
        self.n_rows, self.batch = int(options["n_rows"]), int(options["batch_size"])
        self.steps, self.at = int(options["steps"]), int(options.get("start", "0"))

    def initialOffset(self) -> dict:  # noqa: N802
        return {"p": 0}

    def latestOffset(self) -> dict:  # noqa: N802
        self.at += self.steps * self.batch
        return {"p": self.at}

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        a, b = int(start["p"]), int(end["p"])
        return [InputPartition((i, min(i + TASK_POSITIONS, b))) for i in range(a, b, TASK_POSITIONS)]

    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        a, b = partition.value
        for i in range(a, b, ARROW_POSITIONS):
            p = np.arange(i, min(i + ARROW_POSITIONS, b), dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(p), pa.array((p // self.n_rows).astype(np.int32)), pa.array(p % self.n_rows),
                 pa.array(p // self.batch), pa.array((p % self.batch).astype(np.int32))],
                names=["p", "epoch", "row_idx", "batch_id", "pos_in_batch"])


def _planned(spark: SparkSession, checkpoint: str) -> int:
    """The position the stream's offset log ends at; 0 where there is none."""
    try:
        logged = spark.read.text(f"{checkpoint}/offsets/*").where(F.col("value").startswith('{"p"')).collect()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    return max((int(json.loads(r["value"])["p"]) for r in logged), default=0)


def indexed_table(df: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """``df`` with ``row_idx``, written to ``path`` once, in order of the index."""
    spark = df.sparkSession
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
    row_index(df, list(keys), out="row_idx").write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def feed_batches(df: DataFrame, keys: Sequence[str], out_path: str, steps: int,
                 batch_size: int = 64, columns: Sequence[str] | None = None) -> DataFrame:
    """Append the next ``steps`` batches of the endless feed to ``out_path``; returns all so far.

    Columns: those of ``df`` (or ``columns``), ``epoch``, ``p``, ``batch_id``
    and ``pos_in_batch``, as :func:`~..operators.batching.repeat_batches` gives
    them.  Progress, and the row index the positions refer to, are kept beside
    the rows, so a later call with the same folder goes on where the last one
    stopped; a batch that was cut short is written again under its own name.
    An empty table has nothing to repeat and is refused.
    """
    spark = df.sparkSession
    rows = indexed_table(df, keys, f"{out_path.rstrip('/')}/_index")
    n = rows.count()
    if not n:
        raise ValueError("no rows to feed")
    checkpoint = _progress(out_path)
    spark.dataSource.register(PositionSource)
    keep = list(columns) if columns is not None else [c for c in rows.columns if c != "row_idx"]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        ends = batch.agg(F.min("p").alias("a"), F.max("p").alias("b")).first()
        if ends["a"] is None:
            return
        wanted = rows
        if ends["b"] - ends["a"] + 1 < n:
            # Less than one epoch: only these rows are read.
            lo, hi = ends["a"] % n, ends["b"] % n
            inside = F.col("row_idx").between(lo, hi) if lo <= hi else \
                (F.col("row_idx") >= lo) | (F.col("row_idx") <= hi)
            wanted = rows.where(inside)
        (batch.join(wanted, "row_idx").select(*keep, "epoch", "p", "batch_id", "pos_in_batch")
         .write.mode("overwrite").parquet(f"{out_path}/trigger={batch_id}"))

    end = _planned(spark, checkpoint) + steps * batch_size
    # A batch that was cut short is a run of its own; the next ones follow it.
    while (at := _planned(spark, checkpoint)) < end:
        stream = (spark.readStream.format(SOURCE)
                  .options(n_rows=n, batch_size=batch_size, steps=(end - at) // batch_size, start=at).load())
        q = (stream.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return spark.read.parquet(out_path).drop("trigger")
