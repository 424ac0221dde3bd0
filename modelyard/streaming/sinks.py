"""Structured Streaming: drain metric rows into a table, score rows as they arrive.

Both queries keep their progress beside their rows, in ``_checkpoint`` under
the output folder (or where the caller says).  A later call with the same
output folder resumes there: it reads only what has arrived since, and no batch
is written twice.  A new output folder starts from the beginning.

* ``drain_to_table`` appends each micro-batch with ``foreachBatch`` into a
  folder keyed by the batch id and overwritten on replay (idempotent sink).
* ``score_stream`` applies a fitted (stateless) PipelineModel to a stream and
  appends predictions to a parquet sink (exactly-once file sink).

``trigger(availableNow=True)`` processes what is there now, in bounded
micro-batches, then stops: the "flush" of a buffered logger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def _progress(out_path: str) -> str:
    """Checkpoint folder of a sink; readers of ``out_path`` skip names with ``_``."""
    return f"{out_path.rstrip('/')}/_checkpoint"


def exact_glob(path: str) -> str:
    """A glob matching exactly ``path``: the file source then takes a single
    file or a folder of files alike (a plain file path is refused as base)."""
    path = path.rstrip("/")
    return f"{path[:-1]}[{path[-1]}]"


def file_stream(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(exact_glob(path))


def drain_to_table(stream: DataFrame, out_path: str, checkpoint: str | None = None,
                   fmt: str = "parquet") -> str:
    """Append every available row once; replays overwrite their own batch folder."""
    ckpt = checkpoint or _progress(out_path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").format(fmt).save(f"{out_path}/batch_id={batch_id}")

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path


def score_stream(stream: DataFrame, model, out_path: str, checkpoint: str | None = None,
                 columns: list[str] | None = None) -> str:
    """Score a stream with a fitted PipelineModel (stateless, append mode)."""
    ckpt = checkpoint or _progress(out_path)
    scored = model.transform(stream)
    if columns:
        scored = scored.select(*columns)
    q = (scored.writeStream.format("parquet").outputMode("append")
         .option("path", out_path).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return out_path
